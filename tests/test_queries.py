"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidewright import registry
from tidewright.operators import signals


def plain(v):
    return round(v, 9) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    want = duck.sql(registry.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    assert got == sorted(repr(tuple(map(plain, r))) for r in want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_policy_reads_whole_texts(spark, tmp_path):
    rows = [(1, "x " * 400 + "password = abcdefgh12345", "src1", "en"), (2, "see /home/someone/file and api_key: abcdefgh12345", "src1", "en"), (3, "plain", "src1", "en"), (13, None, "src1", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").selectExpr("*", "length(text) AS n_chars")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = {("src1-1", "secret-like token present (assignment)"), ("src1-2", "absolute user-home path present"), ("src1-2", "secret-like token present (assignment)")}
    got = {(r.id, r.message) for r in registry.QUERIES["policy_text_violations"](spark, str(tmp_path)).where("path = 'policy'").collect()}
    assert got == want


def test_signal_keys_keep_words_that_look_like_commits(spark, tmp_path):
    """An invented word of the letters a to f alone, a commit and a missing identifier, against the query's SQL."""
    texts = ["ing reinst aeaeaea thath", "moved in abc1234 and def56789", "DEADBEEF  is\na word", "no hex", "?!", None]
    rows = [(i, turn, "user", t) for i in (1, 2, None) for turn in (0, 1, 3) for t in texts]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = registry.QUERIES["signal_keys"](spark, str(tmp_path)).select("conv_id", "turn", "ack", "key").collect()
    want = con.sql(registry.ORACLES["signal_keys"]).fetchall()
    assert len(want) == 36 and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_body_key_masks_commits_of_acknowledgements_only(spark):
    rows = [(0, "Fixed in abc1234: as in DEF5678"), (1, "Fixed in abc1234: as in aaa9999"), (2, "as in DEF5678"), (3, "Fixed in abc1234: ...")]
    keys = {r.i: r.key for r in spark.createDataFrame(rows, "i int, body string").select("i", signals.body_key(F.col("body")).alias("key")).collect()}
    assert keys == {0: "as in <sha>", 1: "as in <sha>", 2: "as in def5678", 3: ""}
