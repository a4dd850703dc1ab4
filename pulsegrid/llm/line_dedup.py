"""Line dedup with two Bloom filters, one of hashes seen once and one of hashes seen twice.

Pass one hashes every line that is long enough, once a document, and counts what falls on each
bit of the filters, combined in every task: bits hit at all make the first filter, bits hit
twice or more the second. Pass two probes the second filter: a line whose bit is not in it is
certainly in one document only and goes no further. The rest are suspected repeats. Only their
128-bit digests shuffle; digests met under two ids are confirmed, with the least id as the first
occurrence. The filters lose no repeat; a false hit costs one more short row in the shuffle.

The lines to drop then meet their text by (id, hash of the text), and the text is put together
again from the lines that stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_arrow_batches, documents, stage

# Fixed values of the contract: the white space around a line that its key leaves out, and the
# code points a key needs.
WHITE = b" \t\n\x0b\x0c\r"
LEAST_CHARS = 10

# Bits of each filter for a line: at most one unique line in eight is a false hit.
BITS_PER_LINE = 8

# Bits in one bitmap, the size that bitmap_construct_agg makes (4 KB).
BITMAP_BITS = 32768

# Above this size a filter is not broadcast: the hashes are joined to it by bitmap number.
BROADCAST_FILTER_BYTES = 64 << 20

# A line is "hot" from max(HOT_LINES, lines / HOT_KEYS) suspected rows on. So there are at most
# HOT_KEYS hot lines, whatever the data, and those few are broadcast.
HOT_LINES = 1_000
HOT_KEYS = 10_000

# Line hashes that one batch out of a Python worker carries.
HASH_ROWS = 1 << 16


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """What tells a line from others: white space stripped at both ends, A-Z lower-cased; None
    if that has fewer than ``least_chars`` code points."""
    key = line.strip(WHITE).lower()
    if len(key) < least_chars or len(key) < 4 * least_chars and len(key.decode("utf-8", "replace")) < least_chars:
        return None
    return key


def _digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def line_hashes(text: bytes, least_chars: int) -> tuple[list[int], list[bytes]]:
    """The positions of a text's lines that have a key, and the digests of their keys."""
    positions, digests = [], []
    for at, line in enumerate(text.split(b"\n")):
        if (key := line_key(line, least_chars)) is not None:
            positions.append(at)
            digests.append(_digest(key))
    return positions, digests


def _hashes(digests: list[bytes]) -> pa.Array:
    """The first eight bytes of every digest as a long."""
    return pa.array(np.frombuffer(b"".join(digests), "<i8")[::2].copy(), pa.int64())


def _distinct_hashes(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[bytes] = []
            for text in batch.column(0):
                held.extend(set(line_hashes(text.as_py() or b"", least_chars)[1]))
                if len(held) >= HASH_ROWS:
                    yield pa.record_batch([_hashes(held)], names=["hash"])
                    held = []
            if held:
                yield pa.record_batch([_hashes(held)], names=["hash"])
    return run


def _line_rows(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            positions: list[int] = []
            digests: list[bytes] = []

            def out() -> pa.RecordBatch:
                row = pa.array(rows, pa.int32())
                return pa.record_batch(
                    [batch.column("id").take(row), batch.column("text_hash").take(row), pa.array(positions, pa.int32()),
                     _hashes(digests), pa.array(digests, pa.binary())],
                    names=["id", "text_hash", "position", "hash", "digest"])

            for k, text in enumerate(batch.column("text")):
                at, found = line_hashes(text.as_py() or b"", least_chars)
                rows.extend([k] * len(at))
                positions.extend(at)
                digests.extend(found)
                if len(rows) >= HASH_ROWS:
                    yield out()
                    rows, positions, digests = [], [], []
            if rows:
                yield out()
    return run


def filter_bits(lines: int) -> int:
    """Size of each filter: a power of two, BITS_PER_LINE for each line at least."""
    bits = BITMAP_BITS
    while bits < lines * BITS_PER_LINE:
        bits *= 2
    return bits


def _bit(hashed: Column, bits: int) -> Column:
    return hashed.bitwiseAND(F.lit(bits - 1).cast("long"))


def bloom_filters(hashes: DataFrame, bits: int) -> DataFrame:
    """Pass one. (bucket, once, twice): bitmaps of the bits that ``hashes.hash`` hits, and of
    those that it hits twice or more."""
    hit = hashes.groupBy(_bit(F.col("hash"), bits).alias("bit")).count()
    low = F.col("bit").bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long"))
    return hit.groupBy(F.shiftright("bit", 15).alias("bucket")).agg(
        F.bitmap_construct_agg(low).alias("once"), F.bitmap_construct_agg(F.when(F.col("count") > 1, low)).alias("twice"))


def suspected(rows: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """The rows of ``rows`` whose ``hash`` is in the filter of hashes seen twice."""
    twice = filters.select("bucket", "twice")
    if bits // 8 <= BROADCAST_FILTER_BYTES:
        twice = F.broadcast(twice)
    at = rows.withColumn("bit", _bit(F.col("hash"), bits)).join(twice, F.shiftright("bit", 15) == F.col("bucket"))
    byte = "cast(conv(hex(substring(twice, cast(bit & 32767 as int) div 8 + 1, 1)), 16, 10) as int)"
    return at.where(f"(shiftright({byte}, cast(bit & 7 as int)) & 1) = 1").select(*rows.columns)


def _order(ident: str = "id") -> Column:
    """Ids in order, null last."""
    return F.struct(F.col(ident).isNull().alias("no_id"), F.col(ident).alias("id"))


def repeated_lines(suspects: DataFrame) -> DataFrame:
    """(digest, first, size) of the suspected lines that two ids hold: the least id and the
    number of suspected rows."""
    groups = suspects.groupBy("digest").agg(
        F.min(_order()).alias("first"), F.max(_order()).alias("last"), F.count("*").alias("size"))
    return groups.where("not (first <=> last)").select("digest", "first", "size")


def lines_to_drop(suspects: DataFrame, repeated: DataFrame) -> DataFrame:
    """(id, text_hash, drops): the positions of the lines that each text loses. Hot lines meet
    the short list of them in place, the rest by digest."""
    hot_from = max(HOT_LINES, -(-suspects.count() // HOT_KEYS))
    hot = repeated.where(F.col("size") >= hot_from).select("digest", F.col("first").alias("hot"))
    at = suspects.join(F.broadcast(hot), "digest", "left")
    rest = at.where("hot is null").drop("hot").join(
        repeated.where(F.col("size") < hot_from).select("digest", "first"), "digest")
    met = at.where("hot is not null").withColumnRenamed("hot", "first").unionByName(rest)
    later = met.where(~_order().eqNullSafe(F.col("first")))
    return later.groupBy("id", "text_hash").agg(F.collect_set("position").alias("drops"))


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, dropped, kept = [], [], []
        for text, drops in zip(batch.column("text"), batch.column("drops"), strict=True):
            text, drops = text.as_py() or b"", drops.as_py()
            if drops:
                lines = text.split(b"\n")
                gone = set(drops)
                total.append(len(lines))
                kept.append(b"\n".join([line for at, line in enumerate(lines) if at not in gone]))
            else:
                total.append(text.count(b"\n") + 1)
                kept.append(text)
            dropped.append(len(drops or ()))
        yield pa.record_batch(
            [batch.column("id"), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "n_lines", "n_dropped", "kept"])


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS) -> DataFrame:
    """Drop every line found in another document of a smaller id.

    Returns one row per row of ``df``: ``id_col``, n_lines, n_dropped, kept_text. Lines are
    compared by :func:`line_key`; lines without a key always stay, and so do all lines of the
    smallest id that holds the key, repeats within it included. Null ids come last. Rows that
    repeat an id count as one document: what the first of them keeps, all of them keep. A null
    text is empty: one empty line. An empty table gives an empty result. Other columns,
    whatever their names, are not read.
    """
    spark = df.sparkSession
    bounded_arrow_batches(spark)
    id_type = df.schema[id_col].dataType
    whole = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(whole).alias("text_hash"), whole.cast("binary").alias("text"))

    lines = df.agg(F.sum(F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).alias("n")).first().n or 0
    bits = filter_bits(lines)
    hashes = docs.select("text").mapInArrow(_distinct_hashes(least_chars), "hash long")
    filters = stage(spark, bloom_filters(hashes, bits), "line-filters")

    row_type = T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL(
        "text_hash long, position int, hash long, digest binary").fields])
    suspects = stage(spark, suspected(docs.mapInArrow(_line_rows(least_chars), row_type), filters, bits)
                     .select("id", "text_hash", "position", "digest"), "line-suspects")
    repeated = stage(spark, repeated_lines(suspects), "line-repeated")
    drops = lines_to_drop(suspects, repeated).withColumnsRenamed({"id": "drop_id", "text_hash": "drop_hash"})

    same = (F.col("text_hash") == F.col("drop_hash")) & F.col("id").eqNullSafe(F.col("drop_id"))
    out_type = T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL(
        "n_lines long, n_dropped long, kept binary").fields])
    kept = docs.join(drops, same, "left").select("id", "text", "drops").mapInArrow(_put_together, out_type)
    return kept.select(F.col("id").alias(id_col), "n_lines", "n_dropped", F.col("kept").cast("string").alias("kept_text"))


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS position
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), decided AS (
  SELECT k.*, coalesce(k.doc_id <> r.first, false) AS dropped FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (NOT dropped), '')) AS kept_sha256
FROM decided GROUP BY doc_id
"""
