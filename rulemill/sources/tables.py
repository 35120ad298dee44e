"""Named tables, file loading, saving and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, location: str, name: str) -> DataFrame:
    """Scan a named table: ``<location>/<name>.parquet``, or a catalog table
    when ``location`` is a database name."""
    if "/" in location:
        return spark.read.parquet(f"{location.rstrip('/')}/{name}.parquet")
    return spark.read.table(f"{location}.{name}")


def save(df: DataFrame, database: str, table: str, mode: str = "overwrite",
         partition_by: tuple[str, ...] = ()) -> str:
    """Save as a managed table, creating its database when needed."""
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    full_name = f"{database}.{table}"
    writer.saveAsTable(full_name)
    return full_name


def load_file(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON or CSV file by its suffix. CSV values stay strings."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "json":
        return spark.read.json(path, multiLine=True)
    if suffix == "csv":
        return spark.read.csv(path, header=True, inferSchema=False)
    raise ValueError(f"unsupported file type: {path}")


def preview(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First ``n`` rows in a stated order; plans as TakeOrderedAndProject."""
    return df.orderBy(*order_by).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
