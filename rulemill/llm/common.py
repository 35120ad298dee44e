"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemill.session import checkpointed as stored  # noqa: F401  (written to the cluster's shared folder)
from rulemill.session import discard  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def partitions(df: DataFrame, least: int = 1) -> int:
    """Shuffle partitions of the session."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
