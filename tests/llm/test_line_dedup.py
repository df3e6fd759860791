from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidewright.llm import common
from tidewright.llm import line_dedup as L


def edited(rnd, x, k):
    x = list(x)
    for _ in range(k):
        kind, i = rnd.choice("sid"), rnd.randrange(len(x))
        if kind == "s":
            x[i] = rnd.choice("abé😀 ")
        elif kind == "i":
            x.insert(i, rnd.choice("abé😀"))
        elif len(x) > 1:
            del x[i]
    return "".join(x)


@pytest.mark.parametrize("t", [1, 2, 3])
def test_banded_distance(spark, t):
    rnd = random.Random(t)
    rows = []
    for _ in range(400):
        a = "".join(rnd.choice("abcé😀 ") for _ in range(rnd.randint(8, 40)))
        b = edited(rnd, a, rnd.randint(0, 5))
        if abs(len(a) - len(b)) <= t < len(a):
            rows.append((a, b))
    df = spark.createDataFrame(rows, "a string, b string").withColumns({"n": F.length("a"), "m": F.length("b")})
    part = df.withColumn("u", L.unlike_part(F.col("a"), F.col("b"), t + 1))
    got = part.select(
        L.banded_distance(F.col("a"), F.col("b"), F.col("n"), F.col("m"), t).alias("d"), F.levenshtein("a", "b").alias("want"), L.pieces_met(F.col("a"), F.col("b"), F.col("n"), t, 4).alias("p"),
        L.banded_distance(F.col("u.a"), F.col("u.b"), F.length("u.a"), F.length("u.b"), t).alias("d_part"), F.levenshtein("u.a", "u.b").alias("want_part"), F.length("u.a").alias("left"),
        F.bit_count(L.pair_map(F.col("a")).bitwiseXOR(L.pair_map(F.col("b")))).alias("bits"), F.col("n"),
    ).collect()
    assert all(r.want_part == r.want and r.bits <= 4 * r.want and r.left > t for r in got) and any(r.left < r.n for r in got)
    assert all((r.d_part == r.want) if r.want <= t else r.d_part > t for r in got)
    assert all((r.d == r.want) if r.want <= t else r.d > t for r in got)
    assert all(r.p for r in got if r.want <= t) and any(r.want <= t for r in got)


def lines(rnd, n=50):
    out = ["ab" * 13, "ba" * 13, "ab" * 12 + "a", *["a" * k for k in range(9, 34)]]
    for _ in range(n):
        base = "".join(rnd.choice("abcde ") for _ in range(rnd.randint(9, 60))).strip() + "."
        out += [edited(rnd, base, rnd.randint(0, 3)).strip() for _ in range(rnd.randint(1, 5))]
    return out


def permitted(a, b):
    n = min(len(a), len(b))
    return 2 if n >= 24 else 1 if n >= 12 else 0


def classes_of(spark, texts):
    """line -> smallest line of its class, from the links of the operator; and how many links there are."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    known, links = L.line_classes(docs)
    links = [(bytes(r.a), bytes(r.b)) for r in links.collect()]
    names = {hashlib.sha256(t.encode()).digest()[:16]: t for t in texts}
    assert all(distance(names[a], names[b]) <= permitted(names[a], names[b]) for a, b in links)
    return components(sorted(names.values()), lambda x, y: (x, y) in pairs or (y, x) in pairs) if (pairs := {(names[a], names[b]) for a, b in links}) else {t: t for t in names.values()}, len(links)


def components(nodes, near):
    root = {x: x for x in nodes}
    for k, a in enumerate(nodes):
        for b in nodes[k + 1 :]:
            if root[a] != root[b] and near(a, b):
                lo, hi = sorted((root[a], root[b]))
                root = {x: lo if r == hi else r for x, r in root.items()}
    return root


@pytest.mark.parametrize(("limit", "hot", "tile"), [(L.BROADCAST_KEYS, L.HOT, 512), (0, L.HOT, 3), (L.BROADCAST_KEYS, 2, 512), (0, 0, 2)])
def test_classes_are_those_of_all_near_pairs(spark, monkeypatch, limit, hot, tile):
    monkeypatch.setattr(L, "BROADCAST_KEYS", limit)
    monkeypatch.setattr(L, "HOT", hot)
    monkeypatch.setattr(common.apart, "__defaults__", (None, None, (), tile))
    texts = sorted({x for x in lines(random.Random(7)) if x})
    got, _ = classes_of(spark, texts)
    assert got == components(texts, lambda a, b: abs(len(a) - len(b)) <= 2 and distance(a, b) <= permitted(a, b))
    assert len(set(got.values())) < len(texts)


def test_links_are_a_tree_where_all_are_near(spark):
    texts = [f"the hundredth line of them all ends in number {i:02d}" for i in range(100)]
    got, n = classes_of(spark, texts)
    assert n == 99 and len(set(got.values())) == 1


def shared_third(n):
    rnd = random.Random(3)
    return ["https://www.example.com/shop/" + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(58)) for _ in range(n)]


def test_a_shared_segment_costs_no_square(spark):
    """4,000 lines that share a third meet by rare pieces: hardly any two are compared."""
    texts = shared_third(4000)
    texts.append(texts[0][:-2] + "??")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = docs.select(L.line_id(F.col("text")).alias("id"), F.col("text").alias("line"), F.length("text").alias("n"))
    groups = L.by_rare_pieces(rows, L.BANDS).groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("own").cast("int")).alias("own")).where("own = 1")
    assert groups.agg(F.sum(F.col("n") * F.col("n"))).first()[0] < 40 * len(texts)
    _, links = L.line_classes(docs)
    assert links.count() == 1


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(rows):
    """doc_id -> removed line numbers, by all pairs."""
    seen = [(i, n, s) for i, text in rows for n, s in enumerate(x.strip(" \t\x0b\x0c\r") for x in (text or "").split("\n")) if s]
    texts = sorted({s for _, _, s in seen})
    root = {s: s for s in texts}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for k, a in enumerate(texts):
        for b in texts[k + 1 :]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= permitted(a, b):
                root[find(b)] = find(a)
    first = {}
    for i, n, s in seen:
        first[find(s)] = min(first.get(find(s), (i, n)), (i, n))
    out = {i: [] for i, _ in rows}
    for i, n, s in seen:
        if first[find(s)] != (i, n):
            out[i].append(n)
    return out


def test_report_and_cleaned_texts(spark):
    rnd = random.Random(9)
    pool = lines(rnd, 12) + ["short", "Short", "s", "", " \t" + "a" * 30 + "  "]
    rows = [(i, "\n".join(rnd.choices(pool, k=rnd.randint(0, 6)))) for i in range(40)] + [(90, None), (91, ""), (92, "x" * 100_000), (93, "x" * 100_000 + "y")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, line_no int")
    want = plain([(i, t) for i, t in rows if i < 92]) | {92: [], 93: [0]}
    got = {r.doc_id: r for r in L.line_report(df).collect()}
    assert {i: r.removed_lines for i, r in got.items()} == want
    assert all(r.n_removed == len(r.removed_lines) and r.n_lines == len((dict(rows)[i] or "").split("\n")) for i, r in got.items())
    clean = L.drop_repeated_lines(df)
    assert clean.columns == df.columns
    for r in clean.collect():
        old = dict(rows)[r.doc_id]
        assert r.text == (old if not want[r.doc_id] else "\n".join(x for n, x in enumerate(old.split("\n")) if n not in want[r.doc_id]))


def test_hot_lines_and_empty_tables(spark):
    rows = [(i, "the very same line in every document") for i in range(2000)]
    got = L.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert got.where("n_removed = 1").count() == 1999 and got.where("n_removed = 0").first().doc_id == 0
    none = spark.createDataFrame([], "doc_id long, text string")
    assert L.line_report(none).isEmpty() and L.drop_repeated_lines(none).isEmpty()
    with pytest.raises(ValueError):
        L.line_classes(none, bands=((6, 2),))


def test_short_repeated_lines_are_found(spark):
    docs = spark.createDataFrame([(1, "short repeated line\nx\n"), (2, "y\nshort repeated line\nx"), (3, "short repeated lime\nX")], "doc_id long, text string")
    assert {r.doc_id: r.removed_lines for r in L.line_report(docs).collect()} == {1: [], 2: [1, 2], 3: [0]}
    assert {r.doc_id: r.removed_lines for r in L.line_report(docs, min_chars=24).collect()} == {1: [], 2: [], 3: []}


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a line", 1, "k"), (2, "a line", 2, "l")], "doc_id long, text string, _tidewright_id int, _tidewright_gone string")
    clean = L.drop_repeated_lines(docs)
    assert clean.columns == docs.columns and sorted(map(tuple, clean.collect())) == [(1, "a line", 1, "k"), (2, "", 2, "l")]


def test_pieces_are_rare_if_lines_of_other_lengths_lack_them_too(spark):
    """One line among 200 that are a character longer, each with four words of its own: it meets none of them."""
    rnd = random.Random(5)
    word = lambda letters: "".join(rnd.choices(letters, k=5))
    base = [word("abcdefghij") for _ in range(60)]
    texts = []
    for i in range(201):
        own = (7, 22, 37, 52) if i == 0 else rnd.sample(range(60), 4)
        texts.append(" ".join(word("klmnopqrst") if k in own else x for k, x in enumerate(base)) + ("" if i == 0 else "!"))
    rows = spark.createDataFrame([(hashlib.sha256(x.encode()).digest()[:16], x, len(x)) for x in texts], "id binary, line string, n int")
    groups = common.materialize(L.by_rare_pieces(rows, L.BANDS), "test-groups")
    mine = groups.where(F.col("own") & (F.col("line") == texts[0])).select("key")
    assert mine.count() == 3 and groups.join(mine, "key").count() == 3
