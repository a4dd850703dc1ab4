"""Session helpers: UTC pinning and the shared scratch area under ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. UTC is part of the semantics (dates derive from naive UTC
# timestamps); the rest are runtime-settable SQL confs.
SESSION_CONFS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "pulsegrid",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session builder. On a cluster, use the cluster's session and call
    :func:`prepare_session` instead."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    confs = {
        **SESSION_CONFS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("PULSEGRID_DRIVER_MEMORY", "8g"),
    }
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for k, v in confs.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Pin the runtime confs the operators depend on (idempotent)."""
    for k, v in SESSION_CONFS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster (a shared filesystem); unset there is an error.
    Only in local mode, as in tests, an unset value gets a fresh local folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not (sc.master or "").startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
            "(staged tables, lineage cuts and stream checkpoints live there)"
        )
    local = tempfile.mkdtemp(prefix="pulsegrid-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything exists at ``path`` on its filesystem (local, HDFS, object store),
    asked through the Hadoop FileSystem API instead of by failing a read."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete folders that :func:`scratch_path` named, once what was read from them has been
    committed elsewhere. Anything outside the scratch area is refused."""
    area = f"{checkpoint_root(spark).rstrip('/')}/pulsegrid/"
    for path in paths:
        if not path.startswith(area):
            raise ValueError(f"not a scratch folder: {path}")
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def stage(spark: SparkSession, df, name: str):
    """Write ``df`` once as Parquet under the checkpoint root and return a DataFrame over the
    written table. Used where one result feeds several branches of a plan: the branches read
    the small written table instead of recomputing it, and the lineage is cut (a lost
    executor recomputes from the written files)."""
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for staged tables and sinks."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/pulsegrid/{name}-{uuid.uuid4().hex[:12]}"
