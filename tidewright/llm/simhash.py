"""SimHash near-deduplication by meet-in-the-middle ball hashing.

A document's fingerprint has a bit set where over half of its shingles' XXH64 (UTF-8, seed 42) have it. Two
fingerprints at most 2r bits apart have a fingerprint in common that is at most r bits from either, so every
distinct fingerprint emits all variants within r (r = 1: itself and 64 more); equal variants meet in a shuffle.
A bucket holds at most as many fingerprints as a ball has points (65), whatever the data, and only its smallest
member is paired with the others: with one variant between them, any two of a bucket are within 2r bits, which
is verified all the same.

`near_links` keeps of the pairs that balls find those whose shingles are similar, repeats included as in fingerprints:
documents of a bucket meet under the smallest of them, then those that are in different components still, in tiles.

Copies never multiply: documents are reduced to distinct fingerprints first. Defined results: null text is empty;
a text without words has fingerprint zero, linked like any other; fewer words than a shingle: the whole sequence;
a null identifier counts as larger than all others when a component is named; repeated rows each get a row; an
empty table gives no rows; further columns of any name are not read.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import apart, connected_components, kept, materialize, release, salt_mask, salt_of, scratch, small, spread, text_or_empty, tune, unused
from .shingle_join import verified

SEED = 42


def fingerprint(text: str, width: int = 3) -> int:
    """The unsigned 64-bit SimHash of one text."""
    words = text.encode().lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += 1 + len(w)
        ends.append(at)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, dtype=np.int64), len(words) - width + 1
    for lo in range(0, n, 65536):  # whole texts, in steps
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo : min(lo + 65536, n)], ends[lo + width - 1 :])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), width) for x in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], schema=schema)

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long with the same bits."""
    tune(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(_fingerprints(width), "id long, fp long")


def ball(radius: int) -> list[int]:
    """The masks of at most `radius` set bits among 64, as signed longs."""
    masks = [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(fp, variant): of every fingerprint all those within half of max_bits (even)."""
    if max_bits % 2 or not 0 < max_bits <= 4:
        raise ValueError("max_bits must be 2 or 4: the ball has half of it as its radius")
    # a fingerprint is eight bytes and makes dozens of variants: dealt to all tasks first, whatever its bytes
    dealt = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    return dealt.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m).cast("bigint")) for m in ball(max_bits // 2)])).alias("variant"))


def fingerprint_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) between distinct values of fps.fp at most max_bits (even) apart; a tree within each bucket, not all pairs."""
    buckets = _variants(fps, max_bits).groupBy("variant").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    pairs = buckets.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return pairs.where(F.col("a") != F.col("b")).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).distinct()


def near_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, max_bits: int = 2, similarity: str = "0.8") -> DataFrame:
    """(a, b): links whose components are those of all pairs of documents with fingerprints at most max_bits apart and
    shingles, repeats included, of at least that Jaccard similarity; rows without identifier are left out."""
    share = Fraction(similarity)
    found = materialize(fingerprints(docs, id_col, text_col, width).where("id IS NOT NULL").distinct(), "balls")
    fps = materialize(found.groupBy("fp").agg(F.count("*").alias("n")), "balls-distinct")
    buckets = _variants(fps, max_bits).groupBy("variant").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    # a fingerprint of several documents is a bucket of its own, whether others are near or not
    buckets = buckets.unionAll(fps.where("n > 1").select(F.col("fp").alias("variant"), F.array("fp")))
    buckets = materialize(buckets.select(F.col("variant").alias("key"), F.explode("fps").alias("fp")).distinct(), "balls-buckets")
    members = materialize(found.join(small(buckets), "fp").select("key", "id").distinct(), "balls-members")
    leads = materialize(members.groupBy("key").agg(F.min("id").alias("a")), "balls-leads")
    star = materialize(members.join(small(leads), "key").where("a <> id").select("a", F.col("id").alias("b")).distinct(), "balls-star")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text")).where("id IS NOT NULL")
    first = verified(star, rows, width, share, "balls-first", repeats=True)
    roots = connected_components(first, "balls")
    named = members.join(roots, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    x, y = (t.alias(k) for k, t in zip("xy", apart(named, "balls")))
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.tile") == F.col("y.tile")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.root") != F.col("y.root")))
    rest = rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    rest = materialize(rest, "balls-rest")
    second = verified(rest, rows, width, share, "balls-second", repeats=True)
    release(found, fps, buckets, members, leads, star, roots, rest)
    return first.unionAll(second)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable), group_size: a row for every row."""
    rows = materialize(fingerprints(docs, id_col, text_col, width), "simhash")
    fps = materialize(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n"), F.bit_or(salt_mask(salt_of(F.col("id")))).alias("salts")), "simhash-distinct")
    roots = connected_components(fingerprint_links(fps, max_bits), "simhash")
    named = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "first", "n", "salts", F.coalesce("root", "fp").alias("root"))
    whole = named.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("group_size"))
    table = materialize(named.select("fp", "salts", "root").join(whole, "root").select("fp", "salts", "component_id", "group_size"), "simhash-named")
    release(fps, roots)
    found = rows.withColumn("salt", salt_of(F.col("id"))).join(spread(table, "salts"), ["fp", "salt"])
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "group_size")


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """docs with one document of each component, the one that names it; rows without identifier stay."""
    gone_id = unused("_gone_id", docs)
    with scratch():
        gone = simhash_groups(docs, id_col, text_col, **kw).where("doc_id <> component_id").select(F.col("doc_id").alias(gone_id))
        gone = kept(materialize(gone.distinct(), "simhash-gone"))
    return docs.join(small(gone), F.col(id_col).cast("bigint") == F.col(gone_id), "left_anti")
