"""The trajectory plan over a stream of raw records: the same function, since it works within a row.

A checkpointed file source takes every new file exactly once, which is what skipping existing records was for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.trajectory import normalize
from ..schemas import RAW


def stream_raw(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    read = spark.readStream.schema(RAW).option("multiLine", True).option("pathGlobFilter", "pr-*.json").option("maxFilesPerTrigger", max_files)
    return read.json(folder)


def write_stream(raw: DataFrame, target: str, checkpoint: str, card: str | None = None) -> StreamingQuery:
    """Trajectories of new records, appended as Parquet; stops when all that is there was read."""
    return normalize(raw, card).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
