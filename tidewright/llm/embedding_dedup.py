"""Embedding near-deduplication by int8 tile products with rigorous error bounds.

Each unit vector x is held as s * q with int8 components q, and the length e of what quantisation lost, |x - s q|, is
kept with it. For two vectors |x.y - s_x s_y q_x.q_y| <= e_x + e_y + e_x e_y, so a pair whose int8 product stays
below the threshold by more than that bound can't be a link. Pairs that may be above are computed again from the
original components in double precision, and only those at the threshold or above are links.

Equal vectors are reduced to one first, with their number; a third of all rows being one vector costs one row. The
distinct vectors are dealt to blocks of at most `block_rows` by a hash of their identifier, and every pair of blocks
is a tile, computed in strips by one task. A tile gives back a link count for each of its vectors and a spanning
forest of its links, never the pairs, so its output is linear in its rows however dense a cluster is. The work grows
with the square of the number of distinct vectors, which is what comparing all of them exactly means.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors
of different lengths don't either; a null identifier gives a row with no links and no component; rows that share an
identifier are one node, each counted among the links of the others; an empty table gives no rows; labels and
further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, release, salt_mask, salt_of, spread, tune

THRESHOLD = 0.9
BLOCK_ROWS = 8192
#: Small tables come in so many blocks of at least so many vectors all the same, so that their tiles are many tasks.
LEAST_BLOCKS, SMALL_BLOCK = 6, 1024
#: Numbers in a block at most: long vectors come in smaller blocks.
BLOCK_CELLS = 1 << 23
STRIP = 512
MOST_PARTITIONS = 20_000
#: Dimensions for which a float32 product of int8 components is exact: 127**2 * 1024 < 2**24.
EXACT_DIMS = 1024


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q as int8, s, e) of unit rows; e is rounded up."""
    s = np.abs(x).max(axis=1) / 127
    q = np.rint(x / s[:, None]).astype(np.int8)
    rest = x - s[:, None] * q
    return q, s, np.sqrt((rest * rest).sum(axis=1)) * (1 + 1e-9) + 1e-12


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows, through float32 while that is exact."""
    if a.shape[1] <= EXACT_DIMS:
        return a.astype(np.float32) @ b.astype(np.float32).T
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, at : at + EXACT_DIMS].astype(np.float32) @ b[:, at : at + EXACT_DIMS].astype(np.float32).T
    return out


def candidates(qa, sa, ea, qb, sb, eb, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose cosine may reach the threshold by the bound; all others provably do not."""
    p = int8_product(qa, qb)
    most_e, most_s = eb.max(), sb.max()
    least = (threshold - (ea + most_e + ea * most_e)) / (sa * most_s)
    # a threshold at or below zero is not met by a smaller scale: compare everything then
    i, j = np.nonzero(p >= least[:, None]) if (least > 0).all() else np.indices(p.shape).reshape(2, -1)
    may = p[i, j] * sa[i] * sb[j] + ea[i] + eb[j] + ea[i] * eb[j] >= threshold
    return i[may], j[may]


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest member) after the links a - b."""
    while True:
        least, new = np.minimum(label[a], label[b]), label.copy()
        for ends in (a, b, label[a], label[b]):
            np.minimum.at(new, ends, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tile_links(x: np.ndarray, times: np.ndarray, split: int | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, label) of the rows of x: all pairs with split None, else those of rows before and from split on."""
    x = unit(x)
    q, s, e = quantise(x)
    n = len(x)
    links, label = np.zeros(n, dtype=np.int64), np.arange(n)
    for lo in range(0, n if split is None else split, STRIP):
        hi = min(lo + STRIP, n if split is None else split)
        other = lo if split is None else split
        i, j = candidates(q[lo:hi], s[lo:hi], e[lo:hi], q[other:], s[other:], e[other:], threshold)
        i, j = i + lo, j + other
        if split is None:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        if len(i) * 20 > (hi - lo) * (n - other):  # a dense cluster: one product is cheaper than pair by pair
            cos = (x[lo:hi] @ x[other:].T)[i - lo, j - other]
        else:
            cos = np.concatenate([np.einsum("ij,ij->i", x[i[k : k + 65536]], x[j[k : k + 65536]]) for k in range(0, len(i), 65536)])
        i, j = i[cos >= threshold], j[cos >= threshold]
        links += np.bincount(i, weights=times[j], minlength=n).astype(np.int64) + np.bincount(j, weights=times[i], minlength=n).astype(np.int64)
        label = joined(label, i, j)
    return links, label


_OUT = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _tile(threshold: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        table = table.sort_by([("block", "ascending"), ("id", "ascending")])
        ids, times, block = (table.column(c).to_numpy() for c in ("id", "times", "block"))
        vectors = table.column("vec").combine_chunks()
        x = np.asarray(vectors.flatten()).reshape(len(ids), -1)
        split = None if i == j else int((block == i).sum())
        if len(ids) < 2 or split in (0, len(ids)):
            return _OUT.empty_table()
        links, label = tile_links(x, times, split, threshold)
        hit = np.flatnonzero(links)
        return pa.table([ids[hit], links[hit], ids[label[hit]]], schema=_OUT)

    return run


def usable(vec: Column) -> Column:
    big = F.lit(float("inf"))
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for every row of vectors."""
    tune(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec")).withColumn("ok", usable(F.col("vec")) & F.col("id").isNotNull())
    distinct = rows.where("ok").groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("times"), F.bit_or(salt_mask(salt_of(F.col("id")))).alias("salts"))
    distinct = materialize(distinct, "vec-distinct")
    sizes = distinct.groupBy(F.size("vec").alias("dims")).agg(F.count("*").alias("n"))
    per_block = F.least(F.lit(block_rows), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_CELLS) / F.col("dims"))))
    # blocks are dealt by hash and so not quite even: a tenth of room
    spread_out = F.least(F.lit(LEAST_BLOCKS), F.ceil(F.col("n") / SMALL_BLOCK))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("n") * 1.1 / per_block), spread_out).cast("int"))
    placed = distinct.withColumn("dims", F.size("vec")).join(sizes.select("dims", "blocks"), "dims")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("dims", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"), "block", F.col("rep").alias("id"), "times", "vec")
    # a tile is much work on few bytes: as many partitions as there are tiles, which adaptive execution does not join
    tiles = sizes.agg(F.coalesce(F.sum(F.expr("blocks * (blocks + 1) / 2")), F.lit(1.0))).first()[0]
    dealt = dealt.repartition(int(min(max(2 * tiles, 1), MOST_PARTITIONS)), "i", "j", "dims")
    found = dealt.groupBy("i", "j", "dims").applyInArrow(_tile(threshold), "id long, links long, root long")
    found = materialize(found, "vec-links")
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "vec")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = distinct.join(links, F.col("rep") == F.col("id"), "left").drop("id").join(roots, F.col("rep") == F.col("node"), "left")
    table = materialize(named.select("vec", "salts", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id")), "vec-named")
    release(found, roots)
    met = rows.where("ok").withColumn("salt", salt_of(F.col("id"))).join(spread(table, "salts"), ["vec", "salt"]).select("id", "n_links", "component_id")
    alone = rows.where("not ok").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return met.unionByName(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
