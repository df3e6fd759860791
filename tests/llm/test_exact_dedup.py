from __future__ import annotations

import hashlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.llm import exact_dedup as E

SCHEMA = "doc_id long, text string, sha string, keep_id int"  # two names that clash with the operator's own


def plain(rows):
    """doc_id -> (keep_id, group_size, sha) by a dictionary."""
    groups = {}
    for i, t in rows:
        norm = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(norm, []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        norm = "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
        out.append((i, min(groups[norm])[2], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \n"), (7, "é 😀"), (8, "é😀"), (9, "x" * 300_000), (10, "x" * 300_000 + " "), (None, "ab"), (None, "q"), (11, "a b"), (12, "ab"), (12, "ab"), (13, "abc"), (14, "abd")]


@pytest.mark.parametrize("combine_bytes", [2000, 5 * E.NODE_BYTES, E.COMBINE_BYTES])
def test_groups_equal_a_dictionary(spark, combine_bytes):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in ROWS], SCHEMA).repartition(3)
    got = E.exact_groups(df, combine_bytes=combine_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()), key=repr) == plain(ROWS)


def test_one_hot_group(spark):
    rows = [(i, "same text" + " " * (i % 3)) for i in range(3000)] + [(5000 + i, f"other {i}") for i in range(100)]
    got = E.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert got.where("kept").count() == 101 and {r.group_size for r in got.collect()} == {3000, 1} and got.where("group_size > 1 and keep_id <> 2").isEmpty()


def test_dropping_keeps_columns_and_owners(spark):
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in ROWS], SCHEMA)
    left = E.drop_exact(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 3, 6, 7, 10, 11, 13, 14]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert E.exact_groups(df).isEmpty() and E.drop_exact(df).isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=40))
def test_trie_holds_what_was_put_in(keys):
    trie = E.PatriciaTrie()
    for i, k in enumerate(keys):
        trie.insert(k, (-len(k), False, i, 1, 1 << (i % 32)))
    got = dict(trie.items())
    assert set(got) == set(keys) and all(got[k][2] == keys.index(k) and got[k][3] == keys.count(k) for k in got)
    assert sum(len(k) for k in set(keys)) + 2 * len(keys) * E.NODE_BYTES >= trie.held == trie.weights()[id(trie.root)] - E.NODE_BYTES


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=8).map(str.encode), max_size=60), st.integers(1, 40))
def test_spilled_subtrees_lose_nothing(keys, nodes):
    trie, budget, out = E.PatriciaTrie(), nodes * E.NODE_BYTES, []
    for k in keys:
        trie.insert(k, (0, False, 7, 1, 0))
        if trie.held > budget:
            out += trie.spill(trie.held - budget // 2)
            assert trie.held == trie.weights()[id(trie.root)] - E.NODE_BYTES <= budget
    out += trie.items()
    counted = {}
    for k, owner in out:
        counted[k] = counted.get(k, 0) + owner[3]
    assert counted == {k: keys.count(k) for k in keys}


def test_heavy_shared_beginnings_are_parted():
    trie = E.PatriciaTrie()
    for i in range(500):
        trie.insert(b"all begin alike " * 100 + b"%03d" % i, (0, False, i, 1, 0))
    assert trie.split > 50
    gone = list(trie.spill(trie.held // 3))
    assert 100 < len(gone) < 400 and len(gone) + sum(1 for _ in trie.items()) == 500


def arrow(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), E._ARROW.types)], schema=E._ARROW)


def test_one_trie_a_partition_shares_beginnings(spark, monkeypatch):
    """What a task combines, and what a partition owns, is one trie whose edges are split where strings part."""
    made = []

    class Seen(E.PatriciaTrie):
        def __init__(self):
            super().__init__()
            made.append(self)

    monkeypatch.setattr(E, "PatriciaTrie", Seen)
    rows = [(b"license text that all of them share " + hashlib.md5(b"%d" % (i % 400)).hexdigest().encode(), 1, i, True, 1, 1) for i in range(1200)]
    combined = [r for b in E.combine(1 << 24)([arrow(rows)]) for r in b.to_pylist()]
    assert len(made) == 1 and made[0].split > 30 and len(combined) == 400
    owned = [r for b in E.own([arrow([tuple(r.values()) for r in sorted(combined, key=lambda r: r["body"])])]) for r in b.to_pylist()]
    assert len(made) == 2 and made[1].split > 30 and len(owned) == 400 and all(r["group_size"] == 3 for r in owned)
    assert {r["keep_id"] for r in owned} == set(range(400))
    monkeypatch.undo()
    df = spark.createDataFrame([(i, f"shared beginning {i}") for i in range(2000)], "doc_id long, text string")
    per = E.owners(df).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per) == 2000 and len(per) <= spark.sparkContext.defaultParallelism * 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=40))
def test_sorted_input_leaves_the_trie_early(keys):
    trie, out, most = E.PatriciaTrie(), [], 0
    for k in sorted(keys):
        out += list(trie.cut_left(k, trie.insert(k, (0, False, 0, 1, 0))))
        most = max(most, sum(1 for _ in trie.items()))
    out += list(trie.items())
    assert sorted(k for k, _ in out) == sorted(set(keys)) and most <= 7  # a path of at most six bytes
