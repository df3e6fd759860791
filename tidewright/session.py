"""Session settings that the plans are written for."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide texts: smaller splits instead of a shuffle
    "spark.sql.files.maxPartitionBytes": "64m",
}


def build(app: str = "tidewright", master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS, which the caller's settings override; master as given, or as the environment has it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def data_root() -> str | None:
    """The folder for raw records from TIDEWRIGHT_DATA_ROOT; blank counts as unset."""
    return (os.environ.get("TIDEWRIGHT_DATA_ROOT") or "").strip() or None


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a folder of this machine only for a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the executors share")
    root = tempfile.mkdtemp(prefix="tidewright-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once a context, whatever their search path holds.

    The driver serves the archive; executors fetch it as any file that was added to the context.
    """
    context, root = spark.sparkContext, Path(__file__).parent
    if context.applicationId in _shipped or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tidewright-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
