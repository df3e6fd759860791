"""Files as tables: raw records, diffs beside them, JSON lines, manifests, pages, cards."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.paths import is_inside
from ..functions.text import strip


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of all pr-*.json below a folder, with their file's name and folder; files sort by name, as text."""
    read = spark.read.schema(schemas.RAW).option("multiLine", True).option("pathGlobFilter", "pr-*.json").option("recursiveFileLookup", True).json(folder)
    path = F.col("_metadata.file_path")
    return read.select("*", F.col("_metadata.file_name").alias("file_name"), F.regexp_replace(path, "/[^/]*$", "").alias("folder"))


def with_sidecars(raw: DataFrame, folder: str) -> DataFrame:
    """raw with sidecar_text: the diff that a record names, from the files of a folder."""
    diffs = raw.sparkSession.read.option("pathGlobFilter", "*.diff").option("recursiveFileLookup", True).format("binaryFile").load(folder)
    return beside_records(raw, diffs)


def beside_records(raw: DataFrame, diffs: DataFrame) -> DataFrame:
    """raw (with folder) and diffs (path, content): sidecar_text is the diff that a record names, if it lies within the record's own folder."""
    found = diffs.select(F.col("path").alias("_path"), F.make_valid_utf8(F.col("content").cast("string")).alias("sidecar_text"))
    named = F.when(is_inside(F.col("diff.sidecar_path")), F.concat(F.col("folder"), F.lit("/"), F.regexp_replace("diff.sidecar_path", r"\A(?:\./)+", "")))
    norm = lambda p: F.regexp_replace(p, r"\A(?:file:)?/+", "/")
    return raw.join(found, norm(named) == norm(F.col("_path")), "left").drop("_path")


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) with line numbers from 1 within each file, blank lines counted and left out.

    Files may be split: rows are numbered within their part, and the parts' row counts, one small row each, are summed up.
    """
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    parts = read.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("path", "block", (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("base"))
    return read.join(parts, ["path", "block"]).select("file", (F.col("at") - F.col("base") + 1).alias("line"), "text").where(strip(F.col("text")) != "")


def trajectories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TRAJECTORY).json(path)


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """All manifests of a folder, the oldest first; an unreadable one is an error."""
    read = spark.read.schema(schemas.MANIFEST).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "*.manifest.json").json(folder)
    return read.orderBy("created_at", "name")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """(file, text) of the Markdown pages of a folder."""
    return spark.read.option("pathGlobFilter", "*.md").text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def card(path: str | None) -> str | None:
    """A card's JSON text; none without a path, an error for a path that is not there."""
    return None if path is None else Path(path).read_text(encoding="utf-8")


