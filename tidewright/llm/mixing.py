"""Mixing sources to target weights: temperature mixing, realised as budgeted block permutations. DataFrame functions only.

A source with token share s gets weight s**a / sum(s**a). The exponent a in [0, 1] is bisected until the weights
meet a target: the entropy of the mixture, or a limit on how often any source is repeated. With a token budget B
source i gets b_i = round(w_i * B) tokens. Without one, B is the least budget under which every source is read
once as a whole, so no document is lost and only small sources repeat.

A source's documents are dealt to about sqrt(documents) blocks by a keyed hash. Each epoch is a keyed permutation of
the blocks; whole epochs take every block, the last one takes blocks in its order until b_i is used up, and the one
block on the edge is cut within, in a keyed order of its documents. So the ordering work of a source is over its
blocks and over one block, both about the square root of its size, and never over all of its rows.

Defined results: null text is empty; a null source is a source of its own; a source without tokens has weight 0 and
is kept once; documents without tokens go with their block; rows that repeat an identifier within a source stay
together; an empty table gives no rows; all other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize, release, text_or_empty, unused

#: Exponents tried in one pass over the sources: a pass halves the bracket five times.
PASS = 31
PASSES = 6
#: With at most so many sources their table is broadcast; otherwise it is joined by shuffle.
BROADCAST_SOURCES = 50_000


@dataclass(frozen=True)
class Target:
    """Either a limit on repetition (> 1), or an entropy in nats; budget: tokens of the mixture, None for full coverage."""

    max_repetition: float | None = 2.0
    entropy: float | None = None
    budget: int | None = None
    seed: str = "mix"


def token_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), 0)).cast("bigint")


def source_key(source_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))


def _unit(*parts) -> Column:
    """A long in [0, 2**60) from md5, the same on every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])), 1, 15), 16, 10).cast("bigint")


def _met(sources: DataFrame, total: int, target: Target, alphas: list[float]) -> list[bool]:
    """For each exponent, whether the target still holds there. Holds at 0 or at 1 and changes once between."""
    share = F.col("tokens") / F.lit(float(total))
    asks = []
    for k, a in enumerate(alphas):
        x = F.pow(share, F.lit(a))
        asks += [F.sum(x).alias(f"z{k}"), F.sum(x * F.log(x)).alias(f"e{k}"), F.max(x / share).alias(f"hi{k}"), F.min(x / share).alias(f"lo{k}")]
    r = sources.where("tokens > 0").agg(*asks).first()
    out = []
    for k in range(len(alphas)):
        z = r[f"z{k}"]
        if target.entropy is not None:
            out.append(math.log(z) - r[f"e{k}"] / z <= target.entropy)
        elif target.budget is None:
            out.append(r[f"hi{k}"] / r[f"lo{k}"] <= target.max_repetition)
        else:
            out.append(r[f"hi{k}"] / z * target.budget / total <= target.max_repetition)
    return out


def exponent(sources: DataFrame, total: int, target: Target) -> float:
    """The smallest exponent in [0, 1] (the flattest mixture) that meets the target; 1 if none does."""
    if (target.max_repetition is None) == (target.entropy is None):
        raise ValueError("a target has either an entropy or a limit on repetition")
    if _met(sources, total, target, [0.0])[0]:
        return 0.0
    lo, hi = 0.0, 1.0  # not met at lo; hi is met or the end
    for _ in range(PASSES):
        tried = [lo + (hi - lo) * k / (PASS + 1) for k in range(1, PASS + 1)]
        first = next((i for i, ok in enumerate(_met(sources, total, target, tried)) if ok), PASS)
        lo, hi = (tried[first - 1] if first else lo), (tried[first] if first < PASS else hi)
    return hi


@dataclass
class Plan:
    """sources: key, tokens, n_docs, blocks, weight, budget, epochs, rest. blocks: key, block, epoch, before, tokens, room."""

    sources: DataFrame
    rows: DataFrame
    blocks: DataFrame
    exponent: float


def _keyed(rows: DataFrame, sources: DataFrame, n_sources: int, seed: str) -> DataFrame:
    small = sources.select("key", "n_blocks")
    return rows.join(F.broadcast(small) if n_sources <= BROADCAST_SOURCES else small, "key").withColumn("block", F.pmod(_unit(seed, F.col("id")), F.col("n_blocks"))).drop("n_blocks")


def plan_mixture(docs: DataFrame, target: Target = Target(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Plan:
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), source_key(source_col).alias("key"), token_count(text_or_empty(text_col)).alias("n_tokens"))
    rows = materialize(rows, "mix-rows")
    sources = materialize(rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")).withColumn("n_blocks", F.ceil(F.sqrt("n_docs"))), "mix-sources")
    n_sources, total = sources.agg(F.count("*"), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    a = exponent(sources, total, target) if total else 1.0
    x = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(a))).otherwise(F.lit(0.0))
    scale = sources.select(F.sum(x).alias("z"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / x)).alias("whole")).first()
    z, budget = scale["z"] or 1.0, target.budget if target.budget is not None else (scale["whole"] or 0.0) * (scale["z"] or 1.0)
    weighted = sources.withColumn("weight", x / F.lit(z)).withColumn("budget", F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(float(budget))).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    weighted = weighted.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(1).cast("bigint")))
    weighted = weighted.withColumn("rest", F.when(F.col("tokens") > 0, F.col("budget") - F.col("epochs") * F.col("tokens")).otherwise(F.lit(0).cast("bigint")))
    weighted = materialize(weighted, "mix-weights")
    keyed = _keyed(rows, weighted, n_sources, target.seed)
    blocks = keyed.groupBy("key", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    small = weighted.select("key", "tokens", "budget", "epochs", "rest", "weight")
    blocks = blocks.join(F.broadcast(small) if n_sources <= BROADCAST_SOURCES else small, "key")
    blocks = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(F.col("rest") > 0, F.col("epochs")).otherwise(F.greatest(F.col("epochs") - 1, F.lit(0).cast("bigint"))))))
    order = Window.partitionBy("key", "epoch").orderBy(_unit(target.seed, "order", F.col("epoch"), F.col("key"), F.col("block")), "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("block_tokens").over(order), F.lit(0).cast("bigint")))
    blocks = blocks.where((F.col("epoch") < F.col("epochs")) | (F.col("before") < F.col("rest")))
    room = F.when((F.col("epoch") == F.col("epochs")) & (F.col("before") + F.col("block_tokens") > F.col("rest")), F.col("rest") - F.col("before"))
    blocks = materialize(blocks.withColumn("room", room), "mix-blocks")
    release(sources)
    return Plan(weighted, keyed, blocks, a)


def _edge(plan: Plan, seed: str) -> DataFrame:
    """(key, block, epoch, id) of the documents that the blocks on the edge still take."""
    edge = plan.blocks.where("room is not null").select("key", "block", "epoch", "room")
    docs = plan.rows.join(edge, ["key", "block"]).groupBy("key", "block", "epoch", "room", "id").agg(F.sum("n_tokens").alias("n"))
    upto = Window.partitionBy("key", "block", "epoch").orderBy(_unit(seed, "doc", F.col("epoch"), F.col("id")), "id").rowsBetween(Window.unboundedPreceding, 0)
    return docs.withColumn("upto", F.sum("n").over(upto)).where("upto <= room").select("key", "block", "epoch", "id")


def mixture(docs: DataFrame, target: Target = Target(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, n_tokens, epoch, weight, position: a row for every copy that the mixture reads.

    Sorted by position (a fraction of the source's own budget) the sources interleave at their weights throughout.
    """
    plan = plan_mixture(docs, target, id_col, text_col, source_col)
    whole = plan.rows.join(plan.blocks.where("room is null"), ["key", "block"])
    cut = plan.rows.join(plan.blocks.where("room is not null"), ["key", "block"])
    edge = materialize(_edge(plan, target.seed), "mix-edge")
    taken = edge.select(F.col("key").alias("k"), F.col("epoch").alias("e"), F.col("id").alias("i"))
    cut = cut.join(taken, (F.col("key") == F.col("k")) & (F.col("epoch") == F.col("e")) & F.col("id").eqNullSafe(F.col("i")), "left_semi")
    within = _unit(target.seed, "doc", F.col("epoch"), F.col("id")) / F.lit(float(1 << 60)) * F.col("block_tokens")
    position = F.when(F.col("budget") > 0, (F.col("epoch") * F.col("tokens") + F.col("before") + within) / F.col("budget")).otherwise(F.lit(0.0))
    source = F.when(F.col("key") == "null", F.lit(None)).otherwise(F.expr("substring(key, 2)"))
    return whole.unionByName(cut).select(F.col("id").alias("doc_id"), source.alias("source"), "n_tokens", "epoch", "weight", position.alias("position"))


def mix_documents(docs: DataFrame, target: Target = Target(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs, each row as often as the mixture reads it, all columns as they were."""
    plan = plan_mixture(docs, target, id_col, text_col, source_col)
    copies = materialize(plan.blocks.groupBy("key", "block").agg(F.count(F.when(F.col("room").isNull(), 1)).alias("copies")), "mix-copies")
    edge = materialize(_edge(plan, target.seed).groupBy("key", "id").agg(F.count("*").alias("more")), "mix-edge")
    n_sources = plan.sources.count()
    key, ident, block, whole, more, n, edge_key, edge_id = (unused(f"_tidewright_{x}", docs) for x in ("key", "id", "block", "copies", "more", "n", "edge_key", "edge_id"))
    small = plan.sources.select(F.col("key").alias(key), F.col("n_blocks").alias(n))
    rows = docs.withColumns({key: source_key(source_col), ident: F.col(id_col).cast("bigint")}).join(F.broadcast(small) if n_sources <= BROADCAST_SOURCES else small, key)
    rows = rows.withColumn(block, F.pmod(_unit(target.seed, F.col(ident)), F.col(n)))
    rows = rows.join(copies.select(F.col("key").alias(key), F.col("block").alias(block), F.col("copies").alias(whole)), [key, block], "left")
    edge = edge.select(F.col("key").alias(edge_key), F.col("id").alias(edge_id), F.col("more").alias(more))
    rows = rows.join(edge, (F.col(key) == F.col(edge_key)) & F.col(ident).eqNullSafe(F.col(edge_id)), "left").drop(edge_key, edge_id)
    times = F.coalesce(F.col(whole), F.lit(0)) + F.coalesce(F.col(more), F.lit(0))
    again = F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("bigint"), times)).otherwise(F.array().cast("array<bigint>")))
    return rows.withColumn(n, again).select(*[docs[c] for c in docs.columns])
