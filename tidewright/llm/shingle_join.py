"""Documents whose sets of word shingles have a Jaccard similarity of at least a threshold: all of them, none by chance.

Two sets that are similar enough share one of the first n - ceil(t * n) + 1 shingles of either, whatever the order of
shingles. Shingles that a sample of documents finds common go last in the order: this changes how many documents meet,
never which are found. Leading shingles are written once as numbers and counted; only those of several documents go
on, and texts are read again only of documents that some pair needs.

A leading shingle's documents meet under the smallest of them, its lead, and so do those of all shingles with the same
lead: there first all with the lead, then those that are in different components still, in tiles of a bounded number of
documents. Of what a pair shares only so much can lie behind the leading shingles of either, so the number of leading
ones that it shares rules most pairs out before their sets are compared; in the second round first within the join, by
bit maps of the leading shingles that can only count too many. So a group of G copies costs G comparisons, documents
that share a passage and no more give no rows, and a pair that is near is compared or linked already.

Defined results: null text is empty; fewer words than a shingle: the whole sequence; null identifiers are left out;
an identifier of several rows stands for each of them; shingles count as equal if their 64-bit XXH64 are; an empty
table has no links; very long texts are read as a whole; further columns of any name are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, connected_components, hashed_sample, kept, materialize, release, salt_mask, salt_of, settle, small, spread, text_or_empty, tune, unused

SEED = 42
#: Words of 64 bits in a bit map of leading shingles: 1024 places for the some hundred that most documents have.
MAP = 16
#: For the order alone: documents sampled, and how many of their most common shingles go last.
SAMPLED, COMMON = 8_000, 1 << 17


#: Tells the repeats of a shingle apart: the one after k others of its kind counts as its XXH64 plus k times this.
REPEAT = 0x9E3779B97F4A7C15


def shingles(text: str, width: int, repeats: bool = False) -> np.ndarray:
    """The distinct XXH64 of a text's shingles, ascending; with repeats a number for each, the first the same."""
    words = text.encode().lower().split()  # bytes: A-Z and [\x20\x09-\x0D] only
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += 1 + len(w)
        ends.append(at)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8").view(np.int64)
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    found = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])], dtype="<u8")
    if repeats:
        found.sort()
        at = np.arange(len(found))
        first = np.maximum.accumulate(np.where(np.append(True, found[1:] != found[:-1]), at, 0))
        found = found + (at - first).astype("<u8") * np.uint64(REPEAT)
    return np.unique(found.view(np.int64))


def _sets(width: int, repeats: bool = False):
    def run(batches):
        for b in batches:
            found = [shingles(x.as_py(), width, repeats) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.int64()))], names=["id", "hashes"])

    return run


def leading(n: int, share: Fraction) -> int:
    """How many first shingles of a set of n must be looked at."""
    return n + (-n * share.numerator // share.denominator) + 1


def _keys(width: int, common: np.ndarray, counts: np.ndarray, share: Fraction):
    def run(batches):
        for b in batches:
            ids, keys, sizes, ends = [], [], [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                hashes = shingles(text.as_py(), width)
                times = np.zeros(len(hashes), dtype=np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
                    times = np.where(common[at] == hashes, counts[at], 0)
                    order = np.lexsort((hashes, times))
                    hashes, times = hashes[order], times[order]
                k = leading(len(hashes), share)
                ends.append(np.full(k, (int(times[k - 1]) << 50) + (int(hashes[k - 1]) >> 14), dtype=np.int64))
                ids.append(np.full(k, i, dtype=np.int64))
                keys.append(hashes[:k])
                sizes.append(np.full(k, len(hashes), dtype=np.int32))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, ids, sizes, ends)], names=["key", "id", "n", "end"])

    return run


def _near(share: Fraction):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both * share.denominator >= share.numerator * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _enough(shared: Column, x: dict[str, Column], y: dict[str, Column], share: Fraction) -> Column:
    """Whether two sets (n, end: where their leading shingles end in the order) that share so many leading ones can be similar enough.

    All others that they share lie behind the leading ones of the set whose leading ones end first.
    """
    behind = lambda s, other: F.least(F.call_function("div", s["n"].cast("bigint") * share.numerator + (share.denominator - 1), F.lit(share.denominator).cast("bigint")) - 1, other["n"])
    more = F.when(x["end"] < y["end"], behind(x, y)).when(x["end"] > y["end"], behind(y, x)).otherwise(F.greatest(behind(x, y), behind(y, x)))
    return (shared + more) * (share.numerator + share.denominator) >= (x["n"].cast("bigint") + y["n"]) * share.numerator


def _side(name: str) -> dict[str, Column]:
    return {k: F.col(f"{name}.{k}") for k in ("n", "end")}


def _held(met: DataFrame) -> DataFrame:
    """(id, n, end, keys, spare, m0, m1, ..): a document's leading shingles that others have too, and their bit map.

    spare: how many of them share their bit with another.
    """
    held = met.groupBy("id", "n", "end").agg(F.collect_set("key").alias("keys"))

    def word(w: int) -> Column:
        mine = F.filter("keys", lambda k: F.pmod(F.call_function("shiftright", k, F.lit(6)), F.lit(MAP)) == w)
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda s, k: s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(k, F.lit(64)).cast("int"))))

    held = held.select("id", "n", "end", "keys", *[word(w).alias(f"m{w}") for w in range(MAP)])
    return held.withColumn("spare", F.size("keys") - sum((F.bit_count(f"m{w}") for w in range(1, MAP)), F.bit_count("m0")))


def _most_shared(x: str, y: str) -> Column:
    """No fewer leading shingles than both share: bits of both, and what may hide behind one."""
    bits = [F.bit_count(F.col(f"{x}.m{w}").bitwiseAND(F.col(f"{y}.m{w}"))) for w in range(MAP)]
    return sum(bits[1:], bits[0]) + F.least(F.col(f"{x}.spare"), F.col(f"{y}.spare"))


def _asked(pairs: DataFrame, held: DataFrame, share: Fraction) -> DataFrame:
    """The pairs (a, b, n_a, n_b) that share enough leading shingles, counted one by one."""
    x, y = (held.select("id", "n", "end", "keys").alias(k) for k in "xy")
    both = pairs.join(x, (F.col("a") == F.col("x.id")) & (F.col("n_a") == F.col("x.n"))).join(y, (F.col("b") == F.col("y.id")) & (F.col("n_b") == F.col("y.n")))
    return both.where(_enough(F.size(F.array_intersect("x.keys", "y.keys")), _side("x"), _side("y"), share)).select("a", "b")


def verified(pairs: DataFrame, rows: DataFrame, width: int, share: Fraction, tag: str, repeats: bool = False) -> DataFrame:
    """The pairs (a, b) of rows (id, text) that are similar enough, by sets or by all shingles, repeats included.

    a may be in very many of them, and comes to them under salts of b.
    """
    ids = materialize(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct(), f"{tag}-ids")
    sets = materialize(rows.join(small(ids), "id").mapInArrow(_sets(width, repeats), "id long, hashes array<long>"), f"{tag}-sets")
    salts = pairs.groupBy(F.col("a").alias("id")).agg(F.bit_or(salt_mask(salt_of(F.col("b")))).alias("salts"))
    x = spread(sets.join(salts, "id").select(F.col("id").alias("a"), F.col("hashes").alias("x"), "salts"), "salts")
    y = pairs.join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b").withColumn("salt", salt_of(F.col("b")))
    near = materialize(y.join(x, ["a", "salt"]).select("a", "b", "x", "y").mapInArrow(_near(share), "a long, b long"), tag)
    release(ids, sets)
    settle(rows.sparkSession)
    return near


def _common(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of documents, ascending, with how many of these hold them."""
    ids = hashed_sample(rows.select("id"), "id", SAMPLED).distinct()
    sets = rows.join(F.broadcast(ids), "id").mapInArrow(_sets(width), "id long, hashes array<long>")
    seen = sets.select(F.explode("hashes").alias("key")).groupBy("key").count().where("count > 2")
    top = sorted((r["key"], r["count"]) for r in seen.orderBy(F.desc("count"), "key").limit(COMMON).collect())
    return np.array([k for k, _ in top], dtype=np.int64), np.array([c for _, c in top], dtype=np.int64)


def shingle_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: str = "0.8", known: DataFrame | None = None) -> DataFrame:
    """(a, b): links whose components are those of all pairs of documents with a similarity of at least that.

    known: a materialized table of links (a, b) that hold already, by whatever rule; they are links of the result, and
    what they connect is not compared again.
    """
    spark, share = docs.sparkSession, Fraction(similarity)
    tune(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text")).where("id IS NOT NULL")
    keys = materialize(rows.mapInArrow(_keys(width, *_common(rows, width), share), "key long, id long, n int, end long"), "shingle-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("many"), F.min("id").alias("lead")).where("many > 1")
    shared = materialize(shared.select("key", "lead"), "shingle-shared")
    met = materialize(keys.join(small(shared), "key"), "shingle-met")
    groups = materialize(met.select(F.col("lead").alias("key"), "id", "n", "end").distinct(), "shingle-groups")
    leads = groups.where("key = id").select("key", F.col("n").alias("n_a"))
    star = groups.where("key <> id").join(leads, "key").select(F.col("key").alias("a"), F.col("id").alias("b"), "n_a", F.col("n").alias("n_b"))
    star = materialize(star.distinct(), "shingle-star")
    held = materialize(_held(met), "shingle-held")
    asked = _asked(star, held, share)
    if known is not None:
        known = known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
        asked = asked.join(known, ["a", "b"], "left_anti")
    asked = materialize(asked.distinct(), "shingle-asked")
    first = verified(asked, rows, width, share, "shingle-first")
    first = first if known is None else first.unionAll(known)
    roots = connected_components(first, "shingle")
    named = groups.join(roots, F.col("id") == F.col("node"), "left").select("key", "id", "n", "end", F.coalesce("root", "id").alias("root"))
    x, y = (t.alias(k) for t, k in zip(apart(named, "shingle", more=held.drop("keys"), on=("id", "n", "end")), "xy"))
    can = _enough(_most_shared("x", "y"), _side("x"), _side("y"), share)
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.tile") == F.col("y.tile")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.root") != F.col("y.root")) & can)
    rest = rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")).distinct()
    rest = materialize(_asked(rest, held, share).distinct().join(star.select("a", "b"), ["a", "b"], "left_anti"), "shingle-rest")
    second = verified(rest, rows, width, share, "shingle-second")
    release(keys, shared, met, groups, star, held, asked, rest, roots)
    return first.unionAll(second)


def drop_linked(docs: DataFrame, links: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs with one document of each component, the one with the smallest identifier; rows without identifier stay."""
    gone_id = unused("_gone_id", docs)
    gone = kept(materialize(connected_components(links, "near").where("node <> root").select(F.col("node").alias(gone_id)), "near-gone"))
    return docs.join(small(gone), F.col(id_col).cast("bigint") == F.col(gone_id), "left_anti")
