from __future__ import annotations

import random
from collections import Counter

import xxhash

from tidewright.llm import simhash as S
from tidewright.llm.common import apart, connected_components


def plain(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


TEXTS = [None, "", " \n", "One", "one two", "ONE two Three", "one two three four", "é Ü ß x y", "a b c a b c a b c", "x " * 70_000, "a\x1cb c d"]


def test_fingerprints(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.id: r.fp & (2**64 - 1) for r in S.fingerprints(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_spark_hash_is_the_same(spark):
    assert spark.sql("SELECT xxhash64('a b c') h").first().h & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_links_lose_none_and_add_none(spark):
    rnd = random.Random(3)
    fps = {rnd.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        for _ in range(15):
            x = f
            for b in rnd.sample(range(64), rnd.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    signed = {f - 2**64 if f >> 63 else f for f in fps}
    near = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = S.fingerprint_links(df)
    assert all(near(r.a, r.b) for r in links.collect())
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = components(signed, near)
    assert {n: r for n, r in want.items() if sum(1 for x in want.values() if x == r) > 1} == got


def test_groups_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, plain(r.text)) for r in docs.collect()]
    first = {}
    for i, f in sorted(rows):
        first.setdefault(f, i)
    roots = components(set(first), lambda a, b: bin(a ^ b).count("1") <= 2)
    best = {}
    for f, r in roots.items():
        best[r] = min(best.get(r, first[f]), first[f])
    want = {i: (f"{f:016x}", best[roots[f]]) for i, f in rows}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in S.simhash_groups(docs).collect()} == want


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b c d", 1), (1, None, 1), (2, "", 1), (3, "a b c d", 1), (3, "a b c d", 1)], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id, r.component_id, r.group_size) for r in S.simhash_groups(df).collect()), key=repr)
    assert got == sorted([(None, 3, 3), (1, 1, 2), (2, 1, 2), (3, 3, 3), (3, 3, 3)], key=repr)
    left = S.drop_near(df)
    assert left.columns == df.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 3, 3]
    assert S.simhash_groups(df.limit(0)).isEmpty() and S.drop_near(df.limit(0)).isEmpty()


def test_components_of_chains_stars_and_rings(spark):
    rnd = random.Random(1)
    ids = rnd.sample(range(10**6), 400)
    edges = [(ids[i], ids[i + 1]) for i in range(99)] + [(ids[100], ids[i]) for i in range(101, 200)] + [(ids[200 + i], ids[200 + (i + 1) % 100]) for i in range(100)] + [(ids[300 + 2 * i], ids[301 + 2 * i]) for i in range(50)]
    edges += [(a, a) for a in ids[:3]] + edges[:5]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges + [(None, 1)], "a long, b long")).collect()}
    pairs = {frozenset(e) for e in edges}
    want = components(set(ids), lambda a, b: frozenset((a, b)) in pairs)
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_named_by_binary_too(spark):
    df = spark.createDataFrame([(b"b", b"a"), (b"c", b"b")], "a binary, b binary")
    assert {bytes(r.node): bytes(r.root) for r in connected_components(df).collect()} == {b"a": b"a", b"b": b"a", b"c": b"a"}


def repeated_texts():
    """Lines that fill most of a text or not so much, with tails of their own; edits of these; nulls and empty texts."""
    rnd = random.Random(11)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    texts = [None, "", " ", "one", "ONE"]
    for size in (1, 3, 7, 11):
        line = words(size)
        for times, tail in ((300, 6), (300, 12), (300, 12), (300, 60), (300, 150), (300, 150), (150, 6)):
            texts.append(" ".join(line * (times // size) + words(tail)))
    base = words(400)
    for n in (0, 1, 1, 40):
        new = list(base)
        for i in rnd.sample(range(400), n):
            new[i] = words(1)[0]
        texts.append(" ".join(new))
    rnd.shuffle(texts)
    return dict(enumerate(texts))


def counted(text):
    words = (text or "").encode().lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) > 5 else Counter([tuple(words)])


def test_near_links_count_repeats(spark, monkeypatch):
    texts = repeated_texts()
    fps, bags = {i: S.fingerprint(t or "", 5) for i, t in texts.items()}, {i: counted(t) for i, t in texts.items()}
    in_ball = lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 2
    alike = lambda a, b: 5 * (bags[a] & bags[b]).total() >= 4 * (bags[a] | bags[b]).total()
    want = components(sorted(texts), lambda a, b: in_ball(a, b) and alike(a, b))
    want = {i: r for i, r in want.items() if sum(1 for x in want.values() if x == r) > 1}
    assert want != {i: r for i, r in components(sorted(texts), in_ball).items() if i in want}  # some that meet are not alike
    df = spark.createDataFrame([*texts.items(), (None, "one")], "doc_id long, text string")
    for tile in (512, 2):
        monkeypatch.setattr(S, "apart", lambda *args, tile=tile: apart(*args, tile=tile))
        links = S.near_links(df).collect()
        assert {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()} == want
        assert all(in_ball(r.a, r.b) and alike(r.a, r.b) for r in links)
    assert S.near_links(df.limit(0)).isEmpty()
