"""Shared streaming plumbing: checkpoint locations, the sessions source, classified
micro-batches, and running a query to completion."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from pulsegrid.operators.quality import classify_sessions
from pulsegrid.schemas import SESSION_FIELDS, SESSIONS_JSON_SCHEMA
from pulsegrid.session import drop_scratch, scratch_path
from pulsegrid.sources.readers import session_columns


def checkpoint_location(spark: SparkSession, name: str, given: str | None = None) -> str:
    """Query checkpoints live under ``spark.checkpoint.dir`` (shared storage), so a restarted
    driver resumes exactly where the last committed micro-batch ended."""
    return given or scratch_path(spark, f"stream-ckpt-{name}")


@contextmanager
def classified_batch(spark: SparkSession, batch: DataFrame, epoch_id: int, quarantine_path: str) -> Iterator[DataFrame]:
    """A micro-batch of raw sessions, classified and written once: the source files are read
    once, and what is quarantined goes to the slice of this micro-batch before the rest is used."""
    path = scratch_path(spark, "stream-classified")
    classified = classify_sessions(batch)
    classified.write.mode("overwrite").parquet(path)
    staged = spark.read.schema(classified.schema).parquet(path)
    staged.where(F.col("dq_reason").isNotNull()).select(*SESSION_FIELDS, "dq_reason") \
        .write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/epoch={epoch_id}")
    yield staged
    drop_scratch(spark, path)


def run_sessions_stream(spark: SparkSession, landing_path: str, load: Callable[[DataFrame, int], None], name: str,
                        checkpoint: str | None, max_files_per_trigger: int) -> StreamingQuery:
    """Run ``load`` over the landed JSON-lines sessions, ``max_files_per_trigger`` files at most
    in a micro-batch, so that a backlog of any size is worked off in bounded steps."""
    raw = spark.readStream.schema(SESSIONS_JSON_SCHEMA).option("mode", "PERMISSIVE") \
        .option("maxFilesPerTrigger", max_files_per_trigger).json(landing_path)
    return run_available_now(session_columns(raw).writeStream.foreachBatch(load)
                             .option("checkpointLocation", checkpoint_location(spark, name, checkpoint)))


def run_available_now(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Process everything available now, in as many micro-batches as the source limits
    allow, then stop."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query failed: {q.exception()}")
    return q
