"""Profiles that add up: one row of counts and sketches per table, column and snapshot.

A new day's rows are read once and appended; the profile of any span of days is merged from the stored rows, without
reading the tables again. Counts, extremes and means are exact. Distinct values come from HyperLogLog sketches
(relative standard error 1.04 / sqrt(2^12), 1.6 %), quantiles from KLL sketches (rank error 1.3 % at k = 200).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_ERROR = 3 * 1.04 / 64  # three standard errors
RANK_ERROR = 0.027  # twice the stated error, for both sides of a rank

_FIELDS = ("n_rows bigint, n_values bigint, total double, low double, high double, low_text string, high_text string, distinct_sketch binary, spread_sketch binary")


def _aggregates(f: T.StructField) -> list[Column]:
    c, none = F.col(f"`{f.name}`"), F.lit(None)
    number = isinstance(f.dataType, T.NumericType)
    scalar = number or isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
    text = c.cast("string")
    value = c.cast("double") if number else none.cast("double")
    return [F.count(F.lit(1)), F.count(c), F.sum(value), F.min(value), F.max(value), F.min(text) if scalar and not number else F.max(none.cast("string")),
            F.max(text) if scalar and not number else F.max(none.cast("string")), F.hll_sketch_agg(text if scalar else none.cast("string")),
            F.kll_sketch_agg_double(value) if number else F.max(none.cast("binary"))]


def sketch(df: DataFrame, table_name: str, snapshot: Column) -> DataFrame:
    """(table_name, snapshot, column_name, counts, extremes and sketches) of every column and snapshot, in one scan. Arrays and
    other types without an order have counts alone. A null snapshot is one like others, named ``none``."""
    names = [x.split(" ")[0] for x in _FIELDS.split(", ")]
    fields = df.schema.fields
    made = df.groupBy(F.coalesce(snapshot.cast("string"), F.lit("none")).alias("snapshot")).agg(
        *[a.alias(f"_{k}_{n}") for k, f in enumerate(fields) for n, a in zip(names, _aggregates(f), strict=True)])
    entries = F.array(*[F.struct(F.lit(f.name).alias("column_name"), *[F.col(f"_{k}_{n}").alias(n) for n in names]) for k, f in enumerate(fields)])
    return made.select(F.lit(table_name).alias("table_name"), "snapshot", F.inline(entries))


def append_sketches(sketches: DataFrame, path: str) -> str:
    """Add snapshots to the history; a snapshot of a table that is there already is replaced, so appending twice changes nothing."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "snapshot").parquet(path))
    return path


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"column_name string, {_FIELDS}, table_name string, snapshot string").parquet(path)


def merged_profile(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The profile of all given snapshots together, per table, column and ``by``."""
    keys = ["table_name", "column_name", *(by or [])]
    one = sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("low_text").alias("low_text"), F.max("high_text").alias("high_text"), F.hll_union_agg("distinct_sketch").alias("d"),
        F.kll_merge_agg_double("spread_sketch").alias("q"))
    spread = F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("q", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))))
    return one.withColumn("_q", spread).select(
        *keys, "n_rows", (F.col("n_rows") - F.col("n_values")).alias("n_nulls"), F.round(F.try_divide(F.col("n_rows") - F.col("n_values"), F.col("n_rows")), 6).alias("null_rate"),
        F.hll_sketch_estimate("d").alias("n_distinct"), "low", "high", "low_text", "high_text", F.round(F.try_divide("total", "n_values"), 4).alias("mean"),
        *[F.col("_q")[k].alias(n) for k, n in enumerate(("p25", "p50", "p75"))])
