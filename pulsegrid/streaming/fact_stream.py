"""The fact flow as a stream. Raw JSON-lines sessions -> quality rules -> distinct grain keys
of the micro-batch -> join to one account per user -> the fact table (``foreachBatch``).

The table is the state: a key that is stored already is not stored again. So no session is too
late or too early to count, whatever the order and size of the micro-batches, and nothing has to
be remembered between them. Quarantined rows go to a table by micro-batch.

Exactly once: the source offsets are in the checkpoint, and a micro-batch that is run again adds
no key twice and rewrites its own slice of the quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.constants import MAX_FILES_PER_TRIGGER
from pulsegrid.operators.accounts import latest_account_per_user
from pulsegrid.operators.activity import attach_country, sessions_to_grain
from pulsegrid.operators.quality import valid_sessions
from pulsegrid.operators.tables import append_new_keys, read_fact_if_exists, upsert_fact
from pulsegrid.schemas import FACT_COLUMNS, FACT_KEYS
from pulsegrid.session import drop_scratch, scratch_path
from pulsegrid.streaming.common import classified_batch, run_sessions_stream


def run_fact_stream(
    spark: SparkSession,
    landing_path: str,
    accounts: DataFrame,
    fact_path: str | None = None,
    checkpoint: str | None = None,
    quarantine_path: str | None = None,
    max_files_per_trigger: int = MAX_FILES_PER_TRIGGER,
    mode: str = "insert_only",
) -> DataFrame:
    """Process what has landed and return the fact table.

    ``insert_only`` adds new keys and never rewrites stored rows. ``replace`` lets a session
    seen again take the country of the present accounts, and rewrites the dates it touches."""
    fact_path = fact_path or scratch_path(spark, "stream-fact")
    quarantine_path = quarantine_path or f"{fact_path.rstrip('/')}_quarantine"
    # Materialise the static side once: the join then reads a small staged table per batch
    # instead of re-aggregating the accounts source every micro-batch.
    accounts_path = scratch_path(spark, "stream-accounts")
    latest_account_per_user(accounts).write.mode("overwrite").parquet(accounts_path)
    accounts_one = spark.read.parquet(accounts_path)

    def load(batch: DataFrame, epoch_id: int) -> None:
        with classified_batch(spark, batch, epoch_id, quarantine_path) as sessions:
            facts = attach_country(sessions_to_grain(valid_sessions(sessions)), accounts_one).select(*FACT_COLUMNS)
            if mode == "replace":
                upsert_fact(spark, facts, fact_path, mode=mode)
                return
            staged = scratch_path(spark, "stream-batch")
            facts.write.mode("overwrite").parquet(staged)
            append_new_keys(spark, spark.read.schema(facts.schema).parquet(staged), fact_path, FACT_KEYS, "activity_date")
            drop_scratch(spark, staged)

    run_sessions_stream(spark, landing_path, load, "fact", checkpoint, max_files_per_trigger)
    drop_scratch(spark, accounts_path)
    return read_fact_if_exists(spark, fact_path)
