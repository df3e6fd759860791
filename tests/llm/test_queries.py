"""Queries of the corpus operators against their SQL, and what all of them must do at least."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from tidewright.llm import registry


def plain(v):
    return round(v, 8) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = registry.queries()[name](spark, sf_dir)
    want = con.sql(registry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*columns).collect())
    assert got == sorted(repr(tuple(map(plain, r))) for r in want.select(*[f'"{c}"' for c in columns]).fetchall())


CONTRACTS = {
    "op1": "doc_id keep_id group_size kept text_sha256", "op2": "doc_id held_out n_tokens n_known train_tokens base_score score", "op4": "vec_id n_links component_id kept",
    "op6": "doc_id n_assign n_access n_hex base_sha256 spans", "op7": "doc_id fingerprint component_id", "op8": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
}


@pytest.mark.parametrize("op", sorted(CONTRACTS))
def test_contract_columns(spark, sf_dir, op):
    name = next(n for n in registry.queries() if n.startswith(f"{op}_"))
    kinds = dict(registry.queries()[name](spark, sf_dir).dtypes)
    assert list(kinds)[: len(CONTRACTS[op].split())] == CONTRACTS[op].split() or set(CONTRACTS[op].split()) <= set(kinds)
    for c in CONTRACTS[op].split():
        want = "boolean" if c in ("kept", "held_out") else "string" if c in ("text_sha256", "base_sha256", "spans", "fingerprint") else "double" if c in ("base_score", "score") else "bigint"
        assert kinds[c] == want, (c, kinds[c])


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_a_row_for_every_row(spark, sf_dir, name):
    if name.startswith(("op3", "op8")):  # a row a copy, a row a piece
        return
    table = "embeddings" if name.startswith("op4") else "documents"
    key = "vec_id" if table == "embeddings" else "doc_id"
    got = registry.queries()[name](spark, sf_dir)
    want = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in want.select(key).collect())
