"""Session helper and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def get_spark(app_name: str = "rulemill", master: str | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    """Build a session with the settings the operators expect.

    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and picks broadcast joins from measured sizes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Sessions of a busy key are merged in each task before the shuffle.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the folder all executors share: the one named in
    ``spark.checkpoint.dir`` or, where that is unset, the session's warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/rulemill-{purpose}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df, purpose: str):
    """Cut lineage by writing to the shared folder and reading it back.

    The shuffle files of the write are removed when it is done: what reads the
    result reads the written table.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library has written, wherever it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames) -> None:
    """Remove tables that ``checkpointed`` wrote, once nothing reads them any more."""
    for df in frames:
        remove(df.sparkSession, df._written)
