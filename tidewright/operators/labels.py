"""Labels of a pull request and the precedence of their sources: card, table of overrides, rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import suffix
from ..functions.text import filled, or_empty, strip
from ..schemas import CARD, USES

#: An override: (repo in lower case, number, field, value); linked issues as a JSON list. The rows are the caller's data.
OVERRIDES = "repo_key string, pr int, field string, value string"
FIELDS = ("training_use", "domain", "task_type", "language", "linked_issues")
#: Quality overrides are keyed by the repository as written, in contrast to all others.
QUALITY = "repo string, pr int, quality double"

# What titles begin with, and the tasks they mean.
TITLES = (("fix", "bugfix"), ("feat", "feature"), ("refactor", "refactor"), ("docs?", "docs"), ("test", "test"), ("perf", "perf"), ("sec(?:urity)?", "security"), ("chore", "chore"))
LABELS = (("bug", "bugfix"), ("enhancement", "feature"), ("documentation", "docs"))
SUFFIXES = ((("rs",), "Rust"), (("jl",), "Julia"), (("py",), "Python"), (("cu", "cuh"), "CUDA"))


def repo_key(repo: Column) -> Column:
    return F.lower(strip(repo))


def outcome(merged: Column, state: Column) -> Column:
    low = F.lower(or_empty(state))
    return F.when(F.coalesce(merged, F.lit(False)), "merged").when(low.isin("closed", "open"), low).otherwise("abandoned")


def title_task(title: Column) -> Column:
    """The task that a title's first word names, or null."""
    out = F.lit(None).cast("string")
    for word, task in reversed(TITLES):
        out = F.when(or_empty(title).rlike(rf"(?iU)\A{word}\b"), task).otherwise(out)
    return out


def label_task(labels: Column) -> Column:
    low, out = F.transform(labels, lambda x: F.lower(x)), F.lit(None).cast("string")
    for label, task in reversed(LABELS):
        out = F.when(F.coalesce(F.array_contains(low, label), F.lit(False)), task).otherwise(out)
    return out


def file_language(names: Column) -> Column:
    """The first language of the list that any file has."""
    ends, out = F.transform(names, suffix), F.lit(None).cast("string")
    for kinds, language in reversed(SUFFIXES):
        out = F.when(F.arrays_overlap(F.coalesce(ends, F.array().cast("array<string>")), F.array(*[F.lit(f".{k}") for k in kinds])), language).otherwise(out)
    return out


def known_use(bucket: Column) -> Column:
    """A bucket's training use; unknown buckets are other. Null without a bucket."""
    return F.when(filled(bucket).isNotNull(), F.when(bucket.isin(*USES), bucket).otherwise("other"))


def override_table(spark: SparkSession, rows: list[tuple[str, int, str, str]]) -> DataFrame:
    return spark.createDataFrame([(r.strip().lower(), n, f, v) for r, n, f, v in rows], OVERRIDES)


#: Up to so many pull requests with overrides their table is broadcast; beyond, it is joined by shuffle.
BROADCAST_PULLS = 200_000


def override_map(overrides: DataFrame) -> DataFrame:
    """(repo_key, pr, table): one map from field to value a pull request.

    A field that is stated twice for one has the value of the row that is last by a column `at`, if the table has
    one, and of equally late rows the largest value.
    """
    late = F.struct("at", "value") if "at" in overrides.columns else F.col("value")
    one = overrides.groupBy("repo_key", "pr", "field").agg(F.max_by("value", late).alias("value")).where("field is not null")
    return one.groupBy("repo_key", "pr").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("table"))


def beside(table: DataFrame, most: int = BROADCAST_PULLS) -> DataFrame:
    """A table to be joined to wide records: broadcast where its counted rows allow, so that the records stay in their partitions."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def with_overrides(raw: DataFrame, overrides: DataFrame | None) -> DataFrame:
    """raw with a column `table`: map from field to value, of overrides for (repository in any case, number)."""
    none = F.create_map().cast("map<string,string>")
    if overrides is None:
        return raw.withColumn("table", none)
    packed = beside(override_map(overrides))
    joined = raw.join(packed, (repo_key(F.col("source.repo")) == F.col("repo_key")) & (F.col("source.pr_number") == F.col("pr")), "left")
    return joined.withColumn("table", F.coalesce("table", none)).drop("repo_key", "pr")


def card_overrides(spark: SparkSession, card: str) -> DataFrame:
    """What a card says by pull request, as rows like those of a table of overrides; values as JSON text."""
    rows = spark.range(1).select(card_column(card).alias("c"))
    parts = [rows.select("c.source_repo", F.lit(field).alias("field"), F.explode(f"c.{field}_by_pr").alias("pr", "value")) for field in ("domain", "task_type", "language", "linked_issues")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return every.select(repo_key(F.col("source_repo")).alias("repo_key"), strip(F.col("pr")).try_cast("int").alias("pr"), "field", json_text(F.col("value")).alias("value")).where("pr is not null")


def stated_twice(cards: DataFrame, overrides: DataFrame) -> DataFrame:
    """(repo_key, pr, field) that both cards and tables state: there should be none."""
    keys = ["repo_key", "pr", "field"]
    return cards.select(*keys).intersect(overrides.select(*keys))


def card_column(card: str | None) -> Column:
    """A dataset card's JSON text as a struct; without one, a card that says nothing."""
    return F.from_json(F.lit(card or "{}"), CARD)


def by_number(entries: Column, number: Column) -> Column:
    """The value of a card's map for a pull request; keys that are no whole numbers are passed over, a later key wins."""
    own = F.filter(F.map_entries(entries), lambda e: F.coalesce(strip(e["key"]).try_cast("int") == number, F.lit(False)))
    return F.get(F.reverse(own), F.lit(0))["value"]


def is_text(value: Column) -> Column:
    """Whether a card's value is a JSON string."""
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def text_value(value: Column) -> Column:
    """A card's value if it is a text that says something, "2024" and "true" included. Numbers, flags and lists are not."""
    return F.when(is_text(value), filled(strip(F.try_variant_get(value, "$", "string"))))


def json_text(value: Column) -> Column:
    """A card's value as a table of overrides would hold it: a text as it is, anything else as JSON; null for null."""
    return F.when(is_text(value), F.try_variant_get(value, "$", "string")).when(F.schema_of_variant(value) != "VOID", F.to_json(value))


def bucket_of(buckets: Column, number: Column) -> Column:
    """The last bucket that lists the pull request."""
    own = F.filter(F.map_entries(buckets), lambda e: F.array_contains(e["value"], number))
    return F.get(F.reverse(own), F.lit(0))["key"]


def training_use(table: Column, card: Column, number: Column) -> Column:
    """Table first, then the card's bucket, then other."""
    return F.coalesce(filled(table["training_use"]), known_use(bucket_of(card["training_use_buckets"], number)), F.lit("other"))


def domain(table: Column, card: Column, number: Column, labels: Column) -> Column:
    cuda = F.when(F.coalesce(F.arrays_overlap(labels, F.array(F.lit("CUDA"), F.lit("cuda"))), F.lit(False)), "gpu-compute")
    return F.coalesce(text_value(by_number(card["domain_by_pr"], number)), table["domain"], F.get(card["domains"], F.lit(0)), cuda, F.lit("systems"))


def task_type(table: Column, card: Column, number: Column, title: Column, labels: Column) -> Column:
    return F.coalesce(text_value(by_number(card["task_type_by_pr"], number)), table["task_type"], title_task(title), label_task(labels), F.lit("other"))


def language(table: Column, card: Column, number: Column, names: Column) -> Column:
    return F.coalesce(text_value(by_number(card["language_by_pr"], number)), filled(strip(table["language"])), filled(card["language"]), file_language(names), F.lit("unknown"))


def issue_numbers(value: Column) -> Column:
    """Issue numbers of a table's or card's JSON text: a list, or one number or text; null where it says nothing usable."""
    listed = F.from_json(value, "array<string>")
    items = F.when(value.isNull(), F.lit(None)).when(value.rlike(r"\A\s*\["), listed).when(value.rlike(r"\A\s*(?:true|false|null|\{.*)\s*\z"), F.lit(None)).otherwise(F.array(value))
    return F.filter(F.transform(items, lambda x: F.when(~F.lower(strip(x)).isin("true", "false"), strip(x).try_cast("bigint"))), lambda n: n.isNotNull() & (n > 0))
