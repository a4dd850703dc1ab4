"""The first step of a stream with bounded state: every micro-batch of the source is read once
and written once, each row under its route.

* ``on_time``: not older than the greatest event time of the micro-batches before, less the
  look-back. A second, stateful query takes these; its watermark never passes them.
* ``late``: older than that. A stateful operator would drop these without a word.
* ``ahead``: at or after ``horizon``, where one is given, so that one wrong clock does not move
  the watermark past all that is still to come.
* ``rejected``: rows that break a rule (``reject`` says which).

The event time reached is kept by micro-batch, beside the number of rows on each route. A
micro-batch that is run again reads the mark of the one before it and rewrites its own slice, so
it takes the same decisions.

Whole micro-batches are published before the second query starts, and that takes all of them:
so the rows of one never meet a watermark that other rows of the same one have moved.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.predicates import ntz_literal
from pulsegrid.session import path_exists
from pulsegrid.streaming.common import run_available_now

ON_TIME, LATE, AHEAD, REJECTED = ROUTES = ("on_time", "late", "ahead", "rejected")
MARK_SCHEMA = "epoch long, reached timestamp_ntz, latest timestamp_ntz, " + ", ".join(f"{r} long" for r in ROUTES)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def interval(length: timedelta) -> str:
    return f"{int(length.total_seconds() * 1000)} milliseconds"


def route_of(floor: datetime | None, horizon: datetime | None):
    """The route of a row by ``reject`` and ``ts``."""
    route = F.when(F.col("reject").isNotNull(), REJECTED)
    if horizon is not None:
        route = route.when(F.col("ts") >= ntz_literal(horizon), AHEAD)
    if floor is not None:
        route = route.when(F.col("ts") < ntz_literal(floor), LATE)
    return route.otherwise(ON_TIME)


def read_marks(spark: SparkSession, base: str) -> DataFrame:
    """One row a micro-batch: ``epoch``, the event time ``reached`` with it, the ``latest`` of its
    own rows, and its rows by route."""
    if not path_exists(spark, f"{base}/marks"):
        return spark.createDataFrame([], MARK_SCHEMA)
    return spark.read.schema(MARK_SCHEMA).parquet(f"{base}/marks/*")


def last_epoch(spark: SparkSession, base: str) -> int:
    """The number of the last routed micro-batch, -1 before the first."""
    found = read_marks(spark, base).agg(F.max("epoch").alias("e")).first().e
    return -1 if found is None else found


def _write_row(spark: SparkSession, path: str, *values: Column) -> None:
    """One row of literals. Made of Python values it would start a Python worker, in each micro-batch."""
    spark.range(0, 1, 1, 1).select(*values).write.mode("overwrite").parquet(path)


def run_router(spark: SparkSession, rows: DataFrame, base: str, look_back: timedelta, horizon: datetime | None = None) -> None:
    """Route what has arrived of ``rows``, a stream with ``ts`` (null only where rejected) and
    ``reject``, to ``base``/routed/epoch=N/route=R."""

    def publish(batch: DataFrame, epoch: int) -> None:
        before = spark.read.schema(MARK_SCHEMA).parquet(f"{base}/marks/{epoch - 1}").first() if epoch else None
        reached = before.reached if before else None
        floor = reached - look_back if reached else None
        path = f"{base}/routed/epoch={epoch}"
        batch.withColumn("route", route_of(floor, horizon)).write.mode("overwrite").partitionBy("route").parquet(path)
        written = spark.read.schema("ts timestamp_ntz, route string").parquet(path)
        found = {r.route: r for r in written.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest")).collect()}
        latest = found[ON_TIME].latest if ON_TIME in found else None
        reached = max((t for t in (reached, latest) if t), default=None)
        times = [(ntz_literal(t) if t else F.lit(None).cast("timestamp_ntz")).alias(name) for name, t in (("reached", reached), ("latest", latest))]
        counts = [F.lit(found[r].n if r in found else 0).cast("long").alias(r) for r in ROUTES]
        _write_row(spark, f"{base}/marks/{epoch}", F.lit(epoch).cast("long").alias("epoch"), *times, *counts)

    run_available_now(rows.writeStream.foreachBatch(publish).option("checkpointLocation", f"{base}/checkpoints/route"))


def routed(spark: SparkSession, base: str, schema: str, *routes: str) -> DataFrame:
    """What was routed, with ``epoch`` and ``route``."""
    schema = f"{schema}, epoch int, route string"
    if last_epoch(spark, base) < 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{base}/routed").parquet(f"{base}/routed")
    return rows.where(F.col("route").isin(*routes))


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """State beside the heap, unless the session names a store. The query takes the setting along when it starts."""
    key = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(key, None)
    if given is None or given.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(key, given) if given else spark.conf.unset(key)


def run_stateful(spark: SparkSession, base: str, schema: str, look_back: timedelta, operator: Callable[[DataFrame], DataFrame],
                 load: Callable[[DataFrame, int], None]) -> None:
    """Run the rows on time, with the watermark on ``event_time``, through a stateful ``operator`` into ``load``."""
    on_time = spark.readStream.schema(schema).parquet(f"{base}/routed/*/route={ON_TIME}")
    stream = on_time.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", interval(look_back))
    with _state_in_rocksdb(spark):
        run_available_now(operator(stream).writeStream.foreachBatch(load).outputMode("append")
                          .option("checkpointLocation", f"{base}/checkpoints/state"))


def side_epochs(spark: SparkSession, base: str) -> tuple[int, int]:
    """First and last micro-batch whose late and ahead rows have not been merged yet."""
    done = -1
    if path_exists(spark, f"{base}/merged"):
        done = spark.read.schema("epoch long").parquet(f"{base}/merged/*").agg(F.max("epoch").alias("e")).first().e
    return done + 1, last_epoch(spark, base)


def side_merged(spark: SparkSession, base: str, epoch: int) -> None:
    _write_row(spark, f"{base}/merged/{epoch}", F.lit(epoch).cast("long").alias("epoch"))


def side_counts(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """``(route, event_date, n)``: rows that came late or lie ahead, by the day they belong to."""
    return routed(spark, base, schema, LATE, AHEAD).groupBy("route", F.col("ts").cast("date").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"))


def drop_on_time(spark: SparkSession, base: str, epochs: list[int]) -> None:
    """Delete the rows on time of micro-batches that the stateful query has taken up for good."""
    for epoch in epochs:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/routed/epoch={epoch}/route={ON_TIME}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_slices(rows: DataFrame, path: str, partition_by: str, load: str) -> None:
    """Add ``rows`` to the table at ``path`` as slice ``load`` of the partitions they belong to. Doing it again replaces the slice."""
    rows.withColumn("load", F.lit(load)).hint("rebalance", partition_by).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by, "load").parquet(path)
