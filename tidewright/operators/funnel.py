"""Selections over whole tables: merged pull requests, sets of numbers, what is there already, and how much a thread yields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled


def merged_pulls(pulls: DataFrame, limit: int = 50) -> DataFrame:
    """The newest-updated merged ones, at most limit."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    real = pulls.where(filled(F.col("merged_at")).isNotNull() & F.col("number").isNotNull())
    return real.orderBy(F.desc("updated_at"), F.desc("number")).limit(limit)


def only_numbers(pulls: DataFrame, numbers: DataFrame, key: str = "number") -> DataFrame:
    return pulls.join(numbers.select(key).distinct(), key, "left_semi")


def not_yet_there(pulls: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """Skip-existing: rows whose key has no record yet."""
    return pulls.join(there.select(*keys).distinct(), keys, "left_anti")


def parse_numbers(text: str) -> list[int]:
    """Numbers of a list by commas; an error for anything else, and for none."""
    parts = [p.strip() for p in text.split(",") if p.strip()]
    numbers = [int(p) for p in parts]
    if not numbers or min(numbers) < 1:
        raise ValueError(f"not a list of numbers: {text!r}")
    return list(dict.fromkeys(numbers))


def yield_funnel(rows: DataFrame, group: str, bot: Column, key: Column, cap: int = 8) -> DataFrame:
    """Per group: all rows, those of people, those that a cap would show, and distinct keys."""
    kept = ~bot
    return rows.groupBy(group).agg(
        F.count("*").alias("n_all"), F.count_if(kept).alias("n_kept"), F.least(F.count_if(kept), F.lit(cap).cast("bigint")).alias("n_shown"), F.count_distinct(F.when(kept, key)).alias("n_unique")
    )
