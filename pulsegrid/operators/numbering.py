"""Numbers for rows in a given order, without a window over all of them in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import stage


def number_rows(df: DataFrame, order_by: list[str], start: int = 1, name: str = "position") -> DataFrame:
    """``df`` with long ``name``: ``start``, ``start + 1``, ... in the order of ``order_by``, which must tell rows apart.

    The rows are dealt out by range and sorted where they are, and written once, each with its
    partition and its place in it. What comes before a partition is a sum over one count a
    partition, the only rows that the driver sees; they are sent back as a small table."""
    spark = df.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).select(
        "*", F.spark_partition_id().alias("_part"), place.alias("_place"))
    rows = stage(spark, placed, "numbered")
    offsets, at = [], start
    for part in sorted(rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((part["_part"], at))
        at += part["n"]
    before = spark.createDataFrame(offsets, "_part int, _before long")
    return rows.join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_place")).alias(name))
