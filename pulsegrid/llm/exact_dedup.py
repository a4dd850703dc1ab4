"""Exact dedup by two-pass Bloom filtering, built from DataFrame functions only.

Pass one hashes every whole text and adds the hash to a counting Bloom filter: one short
counter per bit, combined map-side. The bits hit at least twice are packed into 4 KB bitmaps.
Pass two probes that filter: a row whose bit was hit once is certainly unique and passes
straight through; only the possibly repeated rows shuffle, by their full digest, which
decides. The filter loses no copy; a false hit only costs one more row in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, documents, stage

# Bits in one bitmap, the size that bitmap_construct_agg makes (4 KB).
BITMAP_BITS = 32768

# Bits of the filter per row: about one unique row in 16 is a false hit.
BITS_PER_ROW = 16

# Above this size the filter is not broadcast: the rows' keys are joined to it by bitmap number.
BROADCAST_FILTER_BYTES = 64 << 20

# A group is "hot" from max(HOT_COPIES, rows / HOT_GROUPS) copies on. So there are at most
# HOT_GROUPS hot groups, whatever the data, and those few are broadcast.
HOT_COPIES = 1_000
HOT_GROUPS = 10_000


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def filter_bits(rows: int) -> int:
    """Size of the filter: a power of two, BITS_PER_ROW for each row at least."""
    bits = BITMAP_BITS
    while bits < rows * BITS_PER_ROW:
        bits *= 2
    return bits


def _position(sha: Column, bits: int) -> Column:
    return F.xxhash64(sha).bitwiseAND(F.lit(bits - 1).cast("long"))


def repeated_filter(hashes: DataFrame, bits: int) -> DataFrame:
    """Pass one. (bucket, bitmap): the bits that at least two rows of ``hashes.sha`` hit."""
    counters = hashes.groupBy(_position(F.col("sha"), bits).alias("position")).count()
    return (
        counters.where("count > 1")
        .groupBy(F.shiftright("position", 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("position").bitwiseAND(F.lit(BITMAP_BITS - 1).cast("long")))
             .alias("bitmap"))
    )


def with_suspicion(df: DataFrame, filt: DataFrame, bits: int) -> DataFrame:
    """``df``, which has ``sha``, with boolean ``suspect``: another row hit the same bit."""
    names = df.columns
    if bits // 8 <= BROADCAST_FILTER_BYTES:
        filt = F.broadcast(filt)
    at = df.withColumn("_position", _position(F.col("sha"), bits))
    probed = at.join(filt, F.shiftright("_position", 15) == F.col("bucket"), "left")
    hit = F.expr("""
        shiftright(cast(conv(hex(substring(bitmap, cast(_position & 32767 as int) div 8 + 1, 1)), 16, 10)
                        as int), cast(_position & 7 as int)) & 1""")
    return probed.select(*(F.col(f"`{c}`") for c in names), F.coalesce(hit == 1, F.lit(False)).alias("suspect"))


def _keys(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """(id, row, sha) of every row, written once: both passes read these short rows."""
    return stage(
        df.sparkSession,
        df.select(
            F.col(f"`{id_col}`").alias("id"),
            F.monotonically_increasing_id().alias("row"),
            digest(F.col(f"`{text_col}`")).alias("sha"),
        ),
        name,
    )


def _groups(suspects: DataFrame) -> DataFrame:
    """One row per digest: the first (id, row), null ids last, and the number of rows."""
    return suspects.groupBy("sha").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first"),
        F.count("*").alias("size"),
    )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Decide for every row of ``df`` which row of its text stays.

    Returns one row per row of ``df``: ``id_col``, keep_id, group_size, kept, text_sha256.
    A null text counts as empty, and empty texts equal each other. Of equal texts the row
    with the smallest id stays, null ids last; of rows that repeat that id exactly one stays
    (the first read). An empty table gives an empty result. Other columns, whatever their
    names, are not read.
    """
    keys = _keys(df, id_col, text_col, "exact-keys")
    rows = keys.count()
    bits = filter_bits(rows)
    filt = stage(df.sparkSession, repeated_filter(keys, bits), "exact-filter")
    probed = with_suspicion(keys, filt, bits)
    unique = probed.where("not suspect").select(
        "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("size"),
        F.lit(True).alias("kept"))
    suspects = probed.where("suspect").drop("suspect")
    groups = stage(df.sparkSession, _groups(suspects), "exact-groups")
    hot = f"size >= {max(HOT_COPIES, -(-rows // HOT_GROUPS))}"
    decided = (
        suspects.join(F.broadcast(groups.where(hot)).withColumnsRenamed({"first": "hot", "size": "hot_size"}),
                      "sha", "left")
    )
    columns = ["id", "sha", F.col("first.id").alias("keep_id"), "size",
               (F.col("first.row") == F.col("row")).alias("kept")]
    of_hot = decided.where("hot is not null").withColumnsRenamed({"hot": "first", "hot_size": "size"})
    of_rest = decided.where("hot is null").drop("hot", "hot_size").join(
        groups.where(f"not ({hot})"), "sha")
    both = unique.unionByName(of_hot.select(*columns)).unionByName(of_rest.select(*columns))
    return both.select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"), "kept",
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row for each text, all columns kept.

    Rows that the filter clears pass straight from the scan to the result. The possibly
    repeated ones meet by digest and id; ties are settled as in :func:`exact_duplicates`,
    but among rows that repeat both id and text any one stays.
    """
    names = df.columns
    keys = _keys(df, id_col, text_col, "exact-keys")
    bits = filter_bits(keys.count())
    filt = stage(df.sparkSession, repeated_filter(keys, bits), "exact-filter")
    first = _groups(with_suspicion(keys, filt, bits).where("suspect")).select(
        F.col("sha").alias("_sha"), F.col("first.id").alias("_keep"))
    # The whole row is one column from here on, so no name of it can clash.
    hashed = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("whole"), F.col(f"`{id_col}`").alias("id"),
                       digest(F.col(f"`{text_col}`")).alias("sha"))
    probed = with_suspicion(hashed, filt, bits)
    clear = probed.where("not suspect").select("whole")
    same = (F.col("sha") == F.col("_sha")) & F.col("id").eqNullSafe(F.col("_keep"))
    stay = probed.where("suspect").join(first, same, "left_semi").dropDuplicates(["sha"]).select("whole")
    return clear.unionByName(stay).select(*(F.col("whole").getField(c).alias(c) for c in names))


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
