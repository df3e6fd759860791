"""What several of the corpus operators share: durable intermediate tables, salted lookups, components."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_root, ship

#: Keys under which what belongs to a group comes back to its rows; the members under one key may be split further by
#: adaptive execution, since a single row stands on the other side.
SALTS = 32

#: The six characters of [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_written: dict[str, SparkSession] = {}
_scope: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("tidewright_scope", default=None)


def tune(spark: SparkSession) -> None:
    """Before any Python on executors: give them the package, and bound the batches of whole texts by rows and bytes."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def materialize(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, has known sizes."""
    spark = df.sparkSession
    path = f"{shared_root(spark).rstrip('/')}/tidewright/{tag}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path, compression=compression)
    _written[path] = spark
    back = spark.read.schema(schema).parquet(path)
    back._tidewright_path = path
    if (scope := _scope.get()) is not None:
        scope.append(back)
    return back


@contextlib.contextmanager
def scratch():
    """Tables that are materialized within are deleted at its end, but for those handed to `kept`, which go to the scope around it."""
    made: list[DataFrame] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        stay = [df for df in made if getattr(df, "_tidewright_kept", False)]
        release(*[df for df in made if not getattr(df, "_tidewright_kept", False)])
        if (around := _scope.get()) is not None:
            for df in stay:
                df._tidewright_kept = False
            around += stay


def kept(df: DataFrame) -> DataFrame:
    """A materialized table that outlives the scope it was made in."""
    df._tidewright_kept = True
    return df


def release(*frames: DataFrame) -> None:
    """Delete materialized tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_tidewright_path", None)
        spark = _written.pop(path, None)
        if spark is not None:
            _delete(spark, path)


def settle(spark: SparkSession) -> None:
    """Let the context cleaner delete the shuffle files of stages that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for path, spark in list(_written.items()):
        with contextlib.suppress(Exception):  # the session may have ended before
            _delete(spark, path)


#: Up to so many rows a written table of a few narrow columns is broadcast (some 16 MB); beyond, it is joined by shuffle.
BROADCAST_ROWS = 200_000


def small(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A materialized narrow table, marked for broadcast if its counted rows allow."""
    return F.broadcast(table) if table.count() <= most else table


def hashed_sample(rows: DataFrame, key: str, most: int, *ties: str) -> DataFrame:
    """At most `most` rows, those of the smallest hash of `key` (then by key and ties): the same ones on every run.

    Rows whose hash is too large to be among them are dropped where they are read, so that one task orders a few
    times `most` rows and not that many from each task.
    """
    n, span = rows.count(), 1 << 40
    rank = F.pmod(F.xxhash64(key), F.lit(span))
    near = rows.where(rank < int(span * 4 * most / n)) if n > 8 * most else rows
    if near is not rows and near.count() < most:  # a key that many rows share can empty the range
        near = rows
    return near.orderBy(rank, key, *ties).limit(most)


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def unused(name: str, df: DataFrame) -> str:
    """name, or with underscores added until no column of df is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def salt_of(id_col: Column) -> Column:
    """0..SALTS-1, from the row's identifier alone, so that a recomputed task deals alike."""
    return F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")


def salt_mask(salt: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), salt)


def spread(table: DataFrame, mask: str, salt: str = "salt") -> DataFrame:
    """One row of `table` for each salt whose bit is set in `mask`: never more rows than were aggregated into it."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.call_function("shiftright", F.col(mask), i).bitwiseAND(F.lit(1)) == 1)
    return table.withColumn(salt, F.explode(bits)).drop(mask)


#: Members of a key that one task compares with all of that key's.
TILE = 512


def apart(members: DataFrame, tag: str, left: Column | None = None, more: DataFrame | None = None, on: tuple[str, ...] = (), tile: int = TILE, *, told: tuple[Column, ...] = (), where: str = "true") -> tuple[DataFrame, DataFrame]:
    """What must still be compared: members (key, id, root, ...) of keys that hold several roots, for a join on (key, tile).

    The second table deals a key's members to tiles of about `tile`, the first (only members where `left` holds) has
    each member once for every tile. So a hot key is as many keys of the join, and no task meets all of its members.
    more: what the comparison needs besides, joined by `on` to those members only that are to be compared.
    told: further sums of a key's members, which come to each of them; only keys go on for which `where` holds.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"), *told).where("lo <> hi").where(where)
    sizes = materialize(sizes.drop("lo", "hi").withColumn("size", F.ceil(F.col("size") / tile).cast("int")).withColumnRenamed("size", "tiles"), f"{tag}-sizes")
    several = members.join(small(sizes), "key")
    several = materialize(several if more is None else several.join(more, list(on)), f"{tag}-apart")
    release(sizes)
    every = (several if left is None else several.where(left)).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return every.drop("tiles"), several.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")).drop("tiles")


def connected_components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the smallest node of its component.

    Every round each node hooks to the smallest node in its closed neighbourhood, and the graph is contracted to
    the hooks; at least half of the nodes that still have edges disappear in two rounds. Neighbourhoods are reduced
    by min with partial aggregation, so there a hub costs one row a task; in the joins with the hooks the edges of a
    hub meet under one key, beside a single row, and adaptive execution splits them where they are many (an edge is
    two narrow values). Callers give trees rather than all pairs, which keeps hubs to the members of a group. Rounds
    are written to the shared folder. Self-loops and repeated edges are ignored; null ends are dropped.
    """
    a, b = F.col("a"), F.col("b")
    left = materialize(edges.where(a != b).select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct(), f"{tag}-edges")
    levels: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select(F.col("lo").alias("node"), F.col("hi").alias("other")).unionAll(left.select("hi", "lo"))
        hooks = materialize(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("parent")), f"{tag}-hooks")
        levels.append(hooks)
        ends = left.join(hooks.select(F.col("node").alias("lo"), F.col("parent").alias("p")), "lo").select("hi", "p")
        ends = ends.join(hooks.select(F.col("node").alias("hi"), F.col("parent").alias("q")), "hi").where("p <> q")
        new = materialize(ends.select(F.least("p", "q").alias("lo"), F.greatest("p", "q").alias("hi")).distinct(), f"{tag}-edges")
        release(left)
        left = new
    if not levels:
        return left.select(F.col("lo").alias("node"), F.col("hi").alias("root"))
    release(left)
    roots = levels[-1].select("node", F.col("parent").alias("root"))
    for hooks in reversed(levels[:-1]):
        up = roots.select(F.col("node").alias("parent"), "root")
        roots = hooks.join(up, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    out = materialize(roots, f"{tag}-roots")
    release(*levels)
    return out
