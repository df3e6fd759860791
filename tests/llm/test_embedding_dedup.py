from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewright.llm import embedding_dedup as E


def plain(rows, threshold=0.9):
    """vec_id -> (links, component) by all pairs in double precision."""
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    links, comp = {}, {i: i for i, _ in good}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, (i, x) in enumerate(good):
        for j, y in good[a + 1 :]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                p, q = find(i), find(j)
                comp[max(p, q)] = min(p, q)
    for i, _ in rows:
        out[i] = (links.get(i, 0), find(i) if i in comp else i)
    return out


def got(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(3)
    out = E.embedding_groups(df, **kw)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows_ = out.collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in rows_)
    return rows_


@pytest.mark.parametrize("block_rows", [8192, 40, 7])
def test_all_pairs(spark, sf_dir, block_rows):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id) for r in got(spark, rows, block_rows=block_rows)} == plain(rows)


def test_copies_odd_vectors_and_clashing_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(50)] + [(60, [2.0, 4.0]), (61, [1.0, 2.1]), (62, None), (63, []), (64, [0.0, 0.0]), (65, [nan, 1.0]), (66, [None, 1.0]), (67, [inf, 1.0]), (68, [1.0, 2.0, 0.0]), (69, [-1.0, -2.0]), (None, [1.0, 2.0])]
    out = got(spark, rows, block_rows=5)
    want = plain(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == want and want[60] == (51, 0)


def test_empty(spark):
    assert not got(spark, [])


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 70), st.sampled_from([0.0, 0.5, 0.9, 0.99]))
def test_bound_loses_no_pair(seed, dims, threshold):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((12, dims)) * 10.0 ** rng.integers(-6, 6, (12, 1))
    x = np.concatenate([x, x[:4] + 0.05 * np.abs(x[:4]).max() * rng.standard_normal((4, dims))])
    u = E.unit(x)
    q, s, e = E.quantise(u)
    exact, rough = u @ u.T, E.int8_product(q, q) * s[:, None] * s[None, :]
    assert (np.abs(exact - rough) <= e[:, None] + e[None, :] + e[:, None] * e[None, :] + 1e-12).all()
    i, j = E.candidates(q, s, e, q, s, e, threshold)
    assert set(zip(*np.nonzero(exact >= threshold))) <= set(zip(i.tolist(), j.tolist()))


def test_long_vectors_are_exact():
    rng = np.random.default_rng(2)
    a = rng.integers(-127, 128, (5, 3000)).astype(np.int8)
    assert (E.int8_product(a, a) == a.astype(np.int64) @ a.astype(np.int64).T).all()


def test_dense_clusters_count_alike():
    rng = np.random.default_rng(4)
    x = np.ones((700, 16)) + 0.01 * rng.standard_normal((700, 16))
    links, label = E.tile_links(x, np.ones(700, dtype=np.int64), None, 0.9)
    assert (links == 699).all() and (label == 0).all()
