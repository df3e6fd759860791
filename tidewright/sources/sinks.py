"""Writers: raw records, trajectories, manifests, marked regions. Files of one dataset are written whole or not at all."""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.checks import PROBLEM, shape_problems
from ..operators.manifest import splice
from ..session import data_root

MAX_INLINE = 256 * 1024
SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}")


class BadRecords(Exception):
    """Some records are not as they must be; nothing was written."""


def inline_split(raw: DataFrame, max_bytes: int = MAX_INLINE) -> DataFrame:
    """raw with diffs above the limit taken out of the record into `sidecar_text`, the record naming the file."""
    d, big = F.col("diff"), F.octet_length("diff.inline") > max_bytes
    name = F.concat(F.lit("pr-"), F.col("source.pr_number").cast("string"), F.lit(".diff"))
    moved = F.struct(F.lit(None).cast("string").alias("inline"), name.alias("sidecar_path"), F.octet_length("diff.inline").cast("bigint").alias("bytes"), d["truncated"].alias("truncated"))
    return raw.withColumn("sidecar_text", F.when(big, d["inline"])).withColumn("diff", F.when(big, moved).otherwise(d))


def raw_dir(explicit: str | None, repo: str, tree: str = "datasets/raw") -> str:
    """Where raw records go: the given folder, or below the data root, or within the tree."""
    slug = repo.replace("/", "_")
    root = data_root()
    return explicit or (f"{root}/raw/{slug}" if root else f"{tree}/{slug}")


def write_raw(raw: DataFrame, folder: str, max_bytes: int = MAX_INLINE) -> None:
    """Parquet by repository, with big diffs in a column of their own, which readers of the rest skip."""
    inline_split(raw, max_bytes).withColumn("repo_dir", F.replace(F.col("source.repo"), F.lit("/"), F.lit("_"))).write.mode("append").partitionBy("repo_dir").parquet(folder)


def write_raw_files(raw: DataFrame, folder: str, max_bytes: int = MAX_INLINE) -> int:
    """One indented pr-N.json a record, and pr-N.diff for a big diff: for exchange, a record at a time on the driver."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    n = 0
    for row in inline_split(raw, max_bytes).select("source.pr_number", F.to_json(F.struct(*[F.col(c) for c in raw.columns]), {"ignoreNullFields": "false"}).alias("json"), "sidecar_text").toLocalIterator():
        _replace(Path(folder) / f"pr-{row.pr_number}.json", json.dumps(json.loads(row.json), indent=2, ensure_ascii=False) + "\n")
        if row.sidecar_text is not None:
            _replace(Path(folder) / f"pr-{row.pr_number}.diff", row.sidecar_text)
        n += 1
    return n


def output_name(card_name: str | None) -> str:
    """A file name from a card's name; never a default."""
    if not card_name or not SAFE.fullmatch(card_name) or ".." in card_name:
        raise ValueError(f"not a safe name: {card_name!r}")
    return f"{card_name}.jsonl"


def _replace(path: Path, text: str) -> None:
    part = path.with_name(path.name + ".part")
    part.write_text(text, encoding="utf-8")
    os.replace(part, path)


def write_trajectories(found: DataFrame, path: str, order: str = "pr_file") -> int:
    """One file of compact JSON lines, or BadRecords and no file. Sorted by `pr-N.json` as text."""
    problems = found.select("id", F.explode(shape_problems().cast(f"array<{PROBLEM}>")).alias("p")).select("id", "p.path", "p.message")
    bad = problems.orderBy("id", "path").limit(20).collect()
    if bad:
        raise BadRecords("; ".join(f"{r.id} [{r.path}] {r.message}" for r in bad))
    rows = found.withColumn(order, F.concat(F.lit("pr-"), F.col("pr_number").cast("string"), F.lit(".json"))).orderBy(order)
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    part, n = target.with_name(target.name + ".part"), 0
    with part.open("w", encoding="utf-8") as f:
        for row in rows.select(F.to_json(F.struct(*[F.col(c) for c in found.columns])).alias("json")).toLocalIterator():
            f.write(row.json + "\n")
            n += 1
    if not n:
        part.unlink()
        raise BadRecords("no records")
    os.replace(part, target)
    return n


def write_trajectory_table(found: DataFrame, path: str) -> int:
    """The same for many records: Parquet by outcome, or BadRecords and no table; a table that was there stays until then.

    Records are written once, beside the place, and counted on the way; the folder is renamed if none was bad.
    """
    spark, part = found.sparkSession, f"{path.rstrip('/')}.part"
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    problems = F.size(shape_problems())
    seen = Observation()
    checked = found.observe(seen, F.count("*").alias("n"), F.count_if(problems > 0).alias("bad"), F.max(F.when(problems > 0, F.col("id"))).alias("example"))
    checked.write.mode("overwrite").partitionBy("outcome").parquet(part)
    got = seen.get
    if got["bad"] or not got["n"]:
        fs.delete(fs_path(part), True)
        raise BadRecords(f"{got['bad']} bad records, among them {got['example']}" if got["bad"] else "no records")
    fs.delete(fs_path(path), True)
    if not fs.rename(fs_path(part), fs_path(path)):
        raise OSError(f"{part} could not be renamed")
    return got["n"]


def write_manifest(manifest: dict, path: str, check: bool = False) -> bool:
    """Whether the file was up to date; written if not, unless only checked."""
    text, target = json.dumps(manifest, indent=2, ensure_ascii=False) + "\n", Path(path)
    fresh = target.exists() and target.read_text(encoding="utf-8") == text
    if not fresh and not check:
        _replace(target, text)
    return fresh


def write_region(path: str, block: str, begin: str, end: str, check: bool = False) -> bool:
    """Whether a page's marked region was up to date; replaced if not, unless only checked."""
    target = Path(path)
    old = target.read_text(encoding="utf-8")
    new = splice(old, block, begin, end)
    if new != old and not check:
        _replace(target, new)
    return new == old
