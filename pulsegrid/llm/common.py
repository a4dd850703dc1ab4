"""Small helpers shared by the operators: inputs, word pattern, sizes, Arrow batches."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import drop_scratch, scratch_path

__all__ = [
    "WORD", "SPACE", "BATCH_BYTES", "documents", "stage", "scratch_path", "ascii_lower",
    "word_count", "id_residue", "byte_slices", "partitions_for", "bounded_arrow_batches",
    "RUN_BYTES", "released", "scratch_scope",
]

# Fixed values of the contracts: what separates words, and what a word is.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Text bytes a Python kernel works on at once; its arrays are a small multiple of this.
BATCH_BYTES = 1 << 20

# The same where a kernel's arrays are many times this.
RUN_BYTES = 1 << 18

# Text bytes one Arrow batch may carry into a Python worker.
ARROW_BATCH_BYTES = 8 << 20


# The scopes that are open in this thread, innermost last: what is staged in one goes when it ends.
_SCOPES: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scratch_scopes", default=())


def stage(spark: SparkSession, df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and return the written table. It goes when the innermost
    :func:`scratch_scope` ends, or the one around that if it ``outlives`` it; outside of any it stays."""
    path = scratch_path(spark, name)
    scopes = _SCOPES.get()[:-1] if outlives else _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop what is staged inside at the end. No plan that is run later may read it."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        drop_scratch(spark, *paths)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def id_residue(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def partitions_for(spark: SparkSession, n_bytes: int, per_partition: int, least: int = 1) -> int:
    """Partitions so that each gets about ``per_partition`` bytes; grows with the data."""
    return max(least, -(-int(n_bytes) // per_partition))


def bounded_arrow_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch brings into a Python worker, by bytes, however long the
    texts are. Only lowers the session's setting, never raises it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64m").rstrip("b")
    if not now.isdigit() or int(now) > ARROW_BATCH_BYTES:
        spark.conf.set(key, str(ARROW_BATCH_BYTES))


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` as a task function that gives freed memory back to the machine when its task ends. Python workers are used
    again, and would else keep for later stages what they once grew to."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another C library than GNU's
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return task


def byte_slices(
    texts: pa.Array, limit: int = BATCH_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``limit`` bytes (one row at least).

    Yields (first row, end row, bytes of the run, offsets of its rows in those bytes).
    Nulls count as empty. The bytes are a view, not a copy.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type)
                                or pa.types.is_large_string(texts.type) else b"")
    n = len(texts)
    if n == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end
