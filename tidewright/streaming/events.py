"""A table of files as a stream, read to its end: each file once, however often the query is started."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_root

_made: list[tuple[SparkSession, str]] = []


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows that a stream over a table's files has appended, with the stream's checkpoint in the shared folder."""
    place = f"{shared_root(spark).rstrip('/')}/tidewright/stream-{uuid.uuid4().hex}"
    _made.append((spark, place))
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    # a stream watches a folder: the table's own, or the one that its single file lies in
    watched, which = (path, "*.parquet") if folder else (sf_dir, f"{name}.parquet")
    rows = spark.readStream.schema(schema).option("pathGlobFilter", which).parquet(watched)
    done = rows.writeStream.format("parquet").option("path", f"{place}/rows").option("checkpointLocation", f"{place}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    done.awaitTermination()
    return spark.read.schema(schema).parquet(f"{place}/rows")


@atexit.register
def _clean() -> None:
    for spark, place in _made:
        with contextlib.suppress(Exception):  # the session may have ended before
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
