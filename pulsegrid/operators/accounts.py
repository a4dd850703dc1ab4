"""Accounts reduced to one row per user (so country is a function of user_id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.timestamps import parse_event_time


def latest_account_per_user(accounts: DataFrame) -> DataFrame:
    """The latest ``updated_at`` wins (unparseable/NULL last), then the smallest country
    (NULL last).

    Written as a ``min`` over an ordering struct instead of a ``row_number`` window: the
    aggregate combines map-side, so a user with millions of account rows costs one row per
    map task in the shuffle, not a single sorted partition.
    """
    upd = parse_event_time("updated_at")
    pick = F.min(
        F.struct(
            upd.isNull().alias("k1"),
            (-F.unix_micros(upd.cast("timestamp"))).alias("k2"),
            F.col("country").isNull().alias("k3"),
            F.col("country").alias("country"),
            F.col("created_at").alias("created_at"),
            F.col("updated_at").alias("updated_at"),
        )
    ).alias("pick")
    return (
        accounts.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(pick)
        .select("user_id", "pick.country", "pick.created_at", "pick.updated_at")
    )
