"""Summaries: a row a trajectory, a manifest a dataset, and the status and index tables made of manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import filled, first_filled

# Markers, headings and table heads of the generated pages.
BEGIN, END = "<!-- BEGIN GENERATED -->", "<!-- END GENERATED -->"
INDEX = r"<!--\s*index:\s*(.+?)\s*\|\s*(.+?)\s*-->"
DASH = "—"
STATUS_NOTE = "<!-- Derived from datasets/manifests/*.manifest.json — do not edit by hand. -->"
DATASETS_HEAD = ("## Extracted datasets", "", "| dataset | source repo | records | schema | extracted |", "|---------|-------------|---------|--------|-----------|")
QUALITY_TITLE = "## Trajectory quality"
QUALITY_HEAD = ("| PR | domain | training_use | task_type | quality | signals | validation |", "|----|--------|--------------|-----------|---------|---------|------------|")
INDEX_NOTE = "<!-- Derived from the index line in each per-repo doc - do not edit by hand. -->"
INDEX_HEAD = ("| Source repo | Doc | Status |", "|-------------|-----|--------|")


def record_row(t: Column | None = None) -> list[Column]:
    """The summary columns of a trajectory."""
    c = (lambda k: t[k]) if t is not None else F.col
    size = lambda k: F.greatest(F.coalesce(F.size(c(k)), F.lit(0)), F.lit(0))
    said = F.transform(c("review_signals"), lambda s: F.coalesce(filled(s["comment"]), filled(s["suggestion"]), F.lit("")))
    return [
        *[c(k).alias(k) for k in ("id", "pr_number", "training_use", "task_type", "domain", "language", "quality_score", "outcome")],
        filled(c("issue_context")).isNotNull().alias("has_issue_context"), size("review_signals").alias("review_signal_count"),
        F.coalesce(F.size(F.array_distinct(said)), F.lit(0)).alias("unique_review_signal_count"), F.coalesce(F.length(c("patch")), F.lit(0)).alias("patch_chars"),
        size("validation").alias("validation_count"), size("source_urls").alias("source_url_count"),
    ]


def datasets(trajectories: DataFrame, by: str) -> DataFrame:
    """(name, record_count) of each dataset, of any size."""
    return trajectories.groupBy(F.col(by).alias("name")).agg(F.count("*").alias("record_count"))


def manifests(trajectories: DataFrame, by: str) -> DataFrame:
    """Per dataset (column `by`): how many records, and their rows in the order of identifiers.

    A manifest is one document that holds all rows of a dataset: for datasets that fit one. `datasets` and
    `record_lines` give counts and lines of larger ones.
    """
    rows = trajectories.select(by, F.struct(*record_row()).alias("row"))
    return rows.groupBy(by).agg(F.count("*").cast("int").alias("record_count"), F.array_sort(F.collect_list("row")).alias("records"))


def file_digest(files: DataFrame) -> DataFrame:
    """(path, sha256, bytes) of files read as binaryFile."""
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("bytes"))


def rollup(found: DataFrame) -> DataFrame:
    """One row: datasets, records, and the latest date as text (empty without any)."""
    return found.agg(F.count("*").alias("extracts"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("trajectories"), F.coalesce(F.max("created_at"), F.lit("")).alias("last_updated"))


def signals_shown(total: Column, unique: Column) -> Column:
    text = lambda x: x.cast("string")
    return F.when(total.isNull() & unique.isNull(), DASH).when(total.isNull(), text(unique)).when(unique.isNull() | (unique == total), text(total)).otherwise(F.concat(text(unique), F.lit(" of "), text(total)))


def record_lines(rows: DataFrame) -> DataFrame:
    """(created_at, name, pr_number, line) of rows (created_at, name, r: a summary row)."""
    shown = lambda x: F.coalesce(filled(x), F.lit(DASH))
    cells = [
        F.concat(F.lit("#"), F.col("r.pr_number").cast("string")), shown(F.col("r.domain")), shown(F.col("r.training_use")), shown(F.col("r.task_type")),
        F.when(F.col("r.quality_score").isNull(), DASH).otherwise(F.format_string("%.2f", "r.quality_score")),
        signals_shown(F.col("r.review_signal_count"), F.col("r.unique_review_signal_count")), F.coalesce(F.col("r.validation_count").cast("string"), F.lit(DASH)),
    ]
    return rows.select("created_at", "name", F.col("r.pr_number").alias("pr_number"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def quality_lines(found: DataFrame) -> DataFrame:
    """The rows of the quality tables of manifests, with their place in their table."""
    return placed(record_lines(found.select("created_at", "name", F.explode("records").alias("r"))))


def placed(lines: DataFrame) -> DataFrame:
    """Lines (created_at, name, pr_number, line) with their place in their dataset's table: by falling number."""
    return lines.withColumn("place", F.row_number().over(Window.partitionBy("created_at", "name").orderBy(F.desc("pr_number"), "line")))


def dataset_lines(found: DataFrame) -> DataFrame:
    """The rows of the table of datasets, with their place: by date, then name. One row a dataset, so that they fit a page."""
    shown = lambda k, other=DASH: first_filled(F.col(k).cast("string"), F.lit(other))
    cells = [F.concat(F.lit("`"), shown("name", "?"), F.lit("`")), shown("source_repo"), shown("record_count"), shown("schema_version"), shown("created_at")]
    lines = found.select("created_at", "name", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    return lines.withColumn("place", F.row_number().over(Window.orderBy("created_at", "name", "line")))


def status_block(found: DataFrame, begin: str = BEGIN, end: str = END) -> str:
    """The generated part of a status page, markers included. Its size is that of the page."""
    total = rollup(found).first()
    listed = dataset_lines(found).orderBy("place").collect()
    tables: dict[tuple, list[str]] = {(r.created_at, r.name): [] for r in listed}
    for r in quality_lines(found).orderBy("created_at", "name", "place").collect():
        tables[r.created_at, r.name].append(r.line)
    out = [begin, "", f"**Last updated:** {total.last_updated or 'unknown'}  ", f"**Extracts:** {total.extracts} · **Trajectories:** {total.trajectories}  ", ""]
    out += [STATUS_NOTE, "", *DATASETS_HEAD, *(r.line for r in listed), "", QUALITY_TITLE]
    for (_, name), rows in tables.items():
        out += ["", f"### {name or '?'}", "", *QUALITY_HEAD, *rows]
    return "\n".join([*out, "", end])


def index_entries(pages: DataFrame) -> DataFrame:
    """(repo, file, status) of pages (file, text), by their index line; a page without one is an error."""
    needed = F.when(F.col("text").rlike(INDEX), F.col("text")).otherwise(F.raise_error(F.concat(F.lit("no index line in "), F.col("file"))).cast("string"))
    rows = pages.where(F.col("file").endswith(".md") & (F.col("file") != "_index.md"))
    return rows.select(F.regexp_extract(needed, INDEX, 1).alias("repo"), "file", F.regexp_extract(needed, INDEX, 2).alias("status"))


def index_block(pages: DataFrame, begin: str = BEGIN, end: str = END) -> str:
    rows = [f"| {r.repo} | [{r.file}]({r.file}) | {r.status} |" for r in index_entries(pages).orderBy("file").collect()]
    return "\n".join([begin, "", INDEX_NOTE, "", *INDEX_HEAD, *rows, "", end])


def splice(text: str, block: str, begin: str = BEGIN, end: str = END) -> str:
    """text with what lies from one marker to the other replaced; each marker must be there once, in order."""
    if text.count(begin) != 1 or text.count(end) != 1:
        raise ValueError("each marker must occur once")
    start, stop = text.index(begin), text.index(end)
    if stop < start:
        raise ValueError("the markers are out of order")
    return text[:start] + block + text[stop + len(end) :]
