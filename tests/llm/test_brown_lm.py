from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewright.llm import brown_lm as B


def words(text):
    return [*(text or "").encode().lower().split(), None]


def base(rows):
    train = [w for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1 for w in words(t)]
    c, n = Counter(train), len(train)
    v = len(c)
    return c, n, {i: sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)) for i, t in rows}


def scored(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1.0, "c") for i, t in rows], "doc_id long, text string, score double, chunk string")
    return {r.doc_id: r for r in B.score_texts(df, **kw).collect()}


@pytest.mark.parametrize("kw", [{}, {"head": 200, "chunk_words": 500, "chunk_tokens": 3000, "n_classes": 12, "heavy": 20}])
def test_contract_columns_on_all_documents(spark, sf_dir, kw):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    c, n, want = base(rows)
    got = scored(spark, rows, **kw)
    assert set(got) == {i for i, _ in rows}
    for i, t in rows:
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 5 == 1, len(words(t)), sum(c[w] > 0 for w in words(t)), n)
        assert r.base_score == pytest.approx(want[i], rel=1e-9) and math.isfinite(r.score)
    held = [i for i, _ in rows if got[i].held_out]
    assert sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_classes_are_found(spark):
    """Two kinds of words that take turns: the model beats any that sees single words only."""
    rnd = random.Random(2)
    kinds = [[f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]]
    rows = [(i, " ".join(rnd.choice(kinds[j % 2]) for j in range(60))) for i in range(200)]
    got = scored(spark, rows, n_classes=6)
    held = [r for r in got.values() if r.held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.25  # log10(2) for a certain turn, less what smoothing costs


@pytest.mark.parametrize("heavy", [0, 2, 1024])
def test_score_equals_a_plain_sum(spark, heavy):
    """All tokens through the same tables, one after the other."""
    rows = [(i, t) for i, t in enumerate(["a b c a b", "b c d", "", None, "a a a a zz", "Q w e", "a b c d", "zz b", "c\x0bd\ta"] * 4)]
    df = spark.createDataFrame(rows, "id long, text string")
    from pyspark.sql import functions as F

    texts = df.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), "id", B.is_held_out(F.col("id")).alias("held_out"))
    chunks = texts.mapInArrow(B._encode(10**6, 10**6), B.CHUNK)
    held = {r.id: r.held_out for r in texts.select("id", "held_out").collect()}
    c = B.cluster(chunks, sum(not h for h in held.values()), 4, 2, 3, heavy)
    known = {bytes(r.word): r.n for r in c.counts.collect()}
    assert known == {w: n for w, n in base(rows)[0].items() if w is not None} and len(c.head) == 3
    klass = {w: (n, int(c.klass[c.head[w]]) if w in c.head else 4) for w, n in known.items()}
    assert c.sizes.tolist() == [*(sum(n for n, k in klass.values() if k == j) for j in range(5)), sum(not h for h in held.values())]
    side = 7
    code = lambda w: (5, c.sizes[5]) if w is None else (klass[w][1], klass[w][0]) if w in klass else (6, 0)
    counts = np.zeros((side, side))
    for i, t in rows:
        if not held[i]:
            prev, single = 5, False
            for w in words(t):
                k, n = code(w)
                one = n == 1
                for p in [prev, 6] if single else [prev]:
                    counts[p, k] += 1
                    counts[p, 6] += one
                prev, single = k, one
    logs = B.transition_logs(counts, c.sizes, c.tokens, c.once)
    want = {}
    for i, t in rows:
        total, prev = 0.0, 5
        for w in words(t):
            k, n = code(w)
            total += logs[prev, k] + (math.log10(n / c.sizes[k]) if w is not None and k < 6 else 0)
            prev = k
        want[i] = total
    got = {r.doc_id: r.score for r in B.score_texts(df.withColumnRenamed("id", "doc_id"), n_classes=4, rounds=2, head=3, heavy=heavy).collect()}
    assert got == pytest.approx(want)


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (6, 6)).astype(float)
    counts[2] = 0
    logs = B.transition_logs(counts, np.array([5.0, 3, 0, 9, 2]), 19, 4)
    assert (10**logs).sum(axis=1) == pytest.approx(np.ones(6))


def bigrams(rows):
    """(word before, word) -> count over training texts, None for the end."""
    out = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            out.update(zip([None, *words(t)], words(t)))
    return out


def plain_likelihood(pairs, klass):
    """By class bigrams, with what the exchange leaves out as constant: pairs of rare words and ends."""
    n, by = Counter(), Counter()
    for (a, b), k in pairs.items():
        n[klass(a), klass(b)] += k
        by[klass(b)] += k
    g = lambda x: x * math.log(x)
    head = lambda c: isinstance(c, int)
    return sum(g(x) for (a, b), x in n.items() if head(a) or head(b)) - 2 * sum(g(x) for c, x in by.items() if head(c))


def turns(seed=2):
    rnd = random.Random(seed)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "abc"]
    return [(i, " ".join(rnd.choice(kinds[j % 3]) for j in range(rnd.randint(0, 60))) + " rare%d" % i) for i in range(120)]


@pytest.mark.parametrize("heavy", [0, 15, 1024])
def test_training_likelihood_never_falls_and_is_that_of_the_classes(spark, heavy):
    rows = turns()
    texts = spark.createDataFrame([(t.encode(), i, zlib.crc32(str(i).encode()) % 5 == 1) for i, t in rows], "text binary, id long, held_out boolean")
    chunks = texts.mapInArrow(B._encode(300, 900), B.CHUNK)
    n_docs = sum(zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows)
    pairs = bigrams(rows)
    for rounds in (0, 1, 6):
        c = B.cluster(chunks, n_docs, 6, rounds, 90, heavy)
        assert all(x < y for x, y in zip(c.likelihoods, c.likelihoods[1:])) and len(c.likelihoods) <= rounds + 1
        klass = lambda w: "end" if w is None else int(c.klass[c.head[w]]) if w in c.head else "rare"  # noqa: B023, E731
        assert c.likelihoods[-1] == pytest.approx(plain_likelihood(pairs, klass), rel=1e-9)
    assert len(c.likelihoods) > 1
    kinds = {}
    for w, i in c.head.items():
        kinds.setdefault(int(c.klass[i]), Counter())[w[:1]] += 1
    assert sum(max(x.values()) for x in kinds.values()) > 0.9 * len(c.head)  # classes hold words of one kind


def test_moves_are_to_where_the_neighbours_are():
    """Two classes that never follow each other, between rarer words (cells 2 and 6) and ends (3 and 7)."""
    like_a, like_b = np.array([0, 0, 90.0, 10, 0, 0, 10, 90]), np.array([0, 0, 10.0, 90, 0, 0, 90, 10])
    table = np.array([like_a * 20 + like_b, like_b * 20])
    g = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    likelihood = lambda t: g(t) - 2 * g(t[:, 4:].sum(axis=1))
    for word, own, best in ((like_b, 0, 1), (like_a, 0, 0), (like_b, 1, 1)):
        tried = []
        for c in (0, 1):
            t = table.copy()
            t[own] -= word
            t[c] += word
            tried.append(likelihood(t))
        assert int(np.argmax(tried)) == best
        assert B.moved_exactly(word[None], np.array([own]), table).tolist() == B.moved(word[None], np.array([own]), table).tolist() == [best]
    assert B.class_likelihood(table, 2) == pytest.approx(likelihood(table))
    assert B.moved(np.zeros((0, 8)), np.zeros(0, dtype=int), table).tolist() == []


def test_a_hot_word_outside_the_head_is_one_row_a_chunk(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    texts = spark.createDataFrame([(b"newword " * 40_000, held, True), (b"a b a", 1000, False)], "text binary, id long, held_out boolean").coalesce(1)
    chunks = texts.mapInArrow(B._encode(10**6, 10**6), B.CHUNK)
    none = spark.sparkContext.broadcast(({}, None, None, None, None))
    rows = chunks.select("chunk", "words", "tokens", "lens", "held").mapInArrow(B._rare(none), B.RARE).collect()
    assert sorted((bytes(r.word), len(r.places) // 4) for r in rows) == [(b"a", 2), (b"b", 1), (b"newword", 40_000)]


def test_long_words_are_not_in_the_head(spark):
    blob = "x" * (B.HEAD_BYTES + 1)
    rows = [(i, f"{blob} and {blob}") for i in range(20)]
    c, n, want = base(rows)
    got = scored(spark, rows, n_classes=3)
    assert all(r.base_score == pytest.approx(want[i]) and r.n_known == 4 and math.isfinite(r.score) for i, r in got.items())


def test_rows_of_neighbours_are_merged_by_owner():
    rng = np.random.default_rng(4)
    owner = np.sort(rng.integers(0, 9, 500))
    codes, n = rng.integers(0, 30, 500), rng.integers(1, 5, 500)
    batches = []
    for lo in range(0, 500, 70):
        part = slice(lo, lo + 70)
        order = np.lexsort((codes[part], owner[part]))
        batches += B._rows_of(owner[part][order], codes[part][order], n[part][order], np.zeros(10))
    want = Counter()
    for o, c, k in zip(owner, codes, n):
        want[int(o), int(c)] += int(k)
    for rows in (1, 20, 8192):
        out = [b for b in B._merge(30, rows)(iter(batches))]
        got = Counter()
        for b in out:
            cs, ns, row = B._entries_of(b.column(2).to_pylist(), b.column(3).to_pylist())
            for c, k, r in zip(cs, ns, row):
                assert (key := (b.column(0)[int(r)].as_py(), int(c))) not in got
                got[key] = int(k)
        assert got == want and sum(b.num_rows for b in out) == len(set(owner.tolist()))


def test_odd_tables(spark):
    got = scored(spark, [(1, None)])  # held out or not, one text
    assert got[1].n_tokens == 1
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.score_texts(df).isEmpty()
    rows = [(None, "a b"), (2, "a b"), (2, "a b"), (3, "a " * 50_000), (4, "x" * 100_000)]
    out = B.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 2, 2, 3, 4] and len({r.score for r in out if r.doc_id == 2}) == 1


def test_nothing_to_train_on(spark):
    ids = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    got = scored(spark, [(ids[0], "a b"), (ids[1], "")])
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in got.values())
