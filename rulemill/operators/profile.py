"""Table profiling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.functions.quantiles import exact_quantiles
from rulemill.functions.text import ISO_8601

SCHEMA_COLUMNS = "table_name string, ordinal int, name string, type string, nullable boolean"


def describe_schema(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: name, type, nullability and order."""
    rows = [(table_name, i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, SCHEMA_COLUMNS)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# Every text that a cast to double may take, and few others: a cast that fails costs an exception for each row.
_MAY_BE_NUMBER = (r"^[\p{Cntrl}\p{Z}\s]*[+-]?(?i:[0-9]*\.?[0-9]*(?:e[+-]?[0-9]+)?|0x[0-9a-f.]+(?:p[+-]?[0-9]+)?|inf(?:inity)?|nan)[dDfF]?"
                  r"[\p{Cntrl}\p{Z}\s]*$")
_STATISTICS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def summary(df: DataFrame) -> DataFrame:
    """The rows of Spark's ``df.summary()``, but only text that may be a number is cast to one."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType))]
    if not cols or "summary" in cols:
        return df.summary()
    texts = set(string_columns(df))
    own = [F.col(f"`{c}`") for c in cols]
    number = [F.when(c.rlike(_MAY_BE_NUMBER), c).try_cast("double") if name in texts else c for name, c in zip(cols, own, strict=True)]
    plain = df.select(*[c.alias(f"t{i}") for i, c in enumerate(own)], *[v.alias(f"v{i}") for i, v in enumerate(number)])
    wide = plain.agg(*[e for i in range(len(cols)) for e in (
        F.count(f"t{i}").alias(f"count{i}"), F.avg(f"v{i}").alias(f"mean{i}"), F.stddev(f"v{i}").alias(f"stddev{i}"), F.min(f"t{i}").alias(f"min{i}"),
        F.percentile_approx(f"v{i}", [0.25, 0.5, 0.75], 10000).alias(f"part{i}"), F.max(f"t{i}").alias(f"max{i}"))])

    def value(stat: str, i: int) -> Column:
        return F.get(f"part{i}", F.lit(int(stat[:-1]) // 25 - 1)) if stat.endswith("%") else F.col(f"{stat}{i}")

    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(stat).alias("summary"), *[value(stat, i).cast("string").alias(c) for i, c in enumerate(cols)]) for stat in _STATISTICS])))


def summarize(df: DataFrame, exact: bool = False) -> DataFrame:
    """Summary statistics of numeric and string columns.

    By default what Spark's own ``summary`` gives (approximate percentiles, all values as
    text). ``exact`` gives one row per column with interpolated percentiles;
    text columns carry only count, minimum and maximum.
    """
    if not exact:
        return summary(df)
    nums, texts = numeric_columns(df), string_columns(df)
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    wide = df.agg(
        *[e for c in nums for e in (
            F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__sd"),
            F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))],
        *[e for c in texts for e in (
            F.count(c).alias(f"{c}__n"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))])
    entries = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("cnt"),
        F.round(f"{c}__mean", 4).alias("mean"), F.round(f"{c}__sd", 4).alias("stddev"),
        F.col(f"{c}__min").alias("min_num"), F.col(f"{c}__max").alias("max_num"),
        none_s.alias("min_text"), none_s.alias("max_text")) for c in nums]
    entries += [F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("cnt"),
        none_d.alias("mean"), none_d.alias("stddev"), none_d.alias("min_num"), none_d.alias("max_num"),
        F.col(f"{c}__min").alias("min_text"), F.col(f"{c}__max").alias("max_text")) for c in texts]
    stats = wide.select(F.inline(F.array(*entries)))
    if not nums:
        return stats.select("*", *[none_d.alias(p) for p in ("p25", "p50", "p75")])
    quartiles = exact_quantiles(df, nums, [0.25, 0.5, 0.75])
    pick = {p: F.round(F.max(F.when(F.col("prob") == q, F.col("value"))), 4).alias(p)
            for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    return stats.join(quartiles.groupBy("column_name").agg(*pick.values()), "column_name", "left")


def sample_rows(df: DataFrame, n: int, key: list[str]) -> DataFrame:
    """First ``n`` rows by a stable key, each as one JSON text."""
    return (df.orderBy(*key).limit(n)
            .select(*key, F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row_json")))


def as_text(col: Column, dtype: T.DataType) -> Column:
    """A value as text in a form that does not depend on the engine."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.round(col, 6).cast("decimal(30,6)").cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    return col.cast("string")


def _orderable(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.NumericType, T.StringType, T.DateType, T.TimestampType,
                                   T.TimestampNTZType, T.BooleanType))


def _no_order() -> list[Column]:
    """Distinct values, minimum, maximum and mean of a column whose values have no order."""
    return [F.lit(None)] * 4


def _profile_row(table_name: str, f: T.StructField, n_rows: Column, n_values: Column, n_distinct: Column,
                 low: Column, high: Column, mean: Column) -> list[Column]:
    numeric = isinstance(f.dataType, T.NumericType)
    return [
        F.lit(table_name).alias("table_name"), F.lit(f.name).alias("column_name"),
        n_rows.alias("n_rows"), (n_rows - n_values).alias("n_nulls"),
        F.round(F.try_divide(n_rows - n_values, n_rows), 6).alias("null_rate"),
        n_distinct.cast("bigint").alias("n_distinct"),
        as_text(low, f.dataType).alias("min_value"), as_text(high, f.dataType).alias("max_value"),
        (F.round(mean, 4) if numeric else F.lit(None).cast("double")).alias("mean")]


def profile(df: DataFrame, table_name: str, approx: bool = True) -> DataFrame:
    """One row per column: rows, nulls, null rate, distinct values, min, max, mean.

    By default one aggregate pass with a sketch for the distinct values. The
    exact form reads each column on its own and counts its values, so repeated
    values shrink before the shuffle and no row is multiplied by the number of
    columns; texts are counted by 128-bit hashes. Of arrays and other types without an order only nulls are counted.
    """
    fields = df.schema.fields
    if not approx:
        return reduce(DataFrame.unionByName, [_exact_profile(df, table_name, f) for f in fields])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for f in fields:
        c = f.name
        aggs.append(F.count(c).alias(f"{c}__n"))
        if _orderable(f):
            aggs += [F.approx_count_distinct(c).alias(f"{c}__d"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
        if isinstance(f.dataType, T.NumericType):
            aggs.append(F.avg(c).alias(f"{c}__avg"))
    entries = F.array(*[F.struct(*_profile_row(
        table_name, f, F.col("_rows"), F.col(f"{f.name}__n"), *([F.col(f"{f.name}__{x}") for x in ("d", "min", "max", "avg")]
                                                                if _orderable(f) else _no_order()))) for f in fields])
    return df.agg(*aggs).select(F.inline(entries))


def _exact_profile(df: DataFrame, table_name: str, f: T.StructField) -> DataFrame:
    if not _orderable(f):
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), F.count(f.name).alias("_values"))
        return counts.select(*_profile_row(table_name, f, F.col("_rows"), F.col("_values"), *_no_order()))
    value, zero = F.col(f.name), F.lit(0).cast("bigint")
    if isinstance(f.dataType, T.StringType):  # texts are told apart by 128-bit hashes, so no text is shuffled
        ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
        counts = df.groupBy(F.unhex(F.md5(value)).alias("h")).agg(F.count(F.lit(1)).alias("_n")).agg(
            F.coalesce(F.sum("_n"), zero).alias("_rows"), F.coalesce(F.sum(F.when(F.col("h").isNotNull(), F.col("_n"))), zero).alias("_values"), F.count("h").alias("_distinct"))
        return counts.select(*_profile_row(table_name, f, F.col("_rows"), F.col("_values"), F.col("_distinct"), ends.select("low").scalar(), ends.select("high").scalar(), F.lit(None)))
    present = F.when(value.isNotNull(), F.col("_n"))
    aggs = [F.coalesce(F.sum("_n"), zero).alias("_rows"), F.coalesce(F.sum(present), zero).alias("_values"),
            F.count(value).alias("_distinct"), F.min(value).alias("_min"), F.max(value).alias("_max")]
    if isinstance(f.dataType, T.NumericType):
        aggs.append(F.try_divide(F.sum(value.cast("double") * F.col("_n")), F.sum(present)).alias("_mean"))
    one = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n")).agg(*aggs)
    return one.select(*_profile_row(
        table_name, f, F.col("_rows"), F.col("_values"), F.col("_distinct"), F.col("_min"), F.col("_max"), F.col("_mean")))


def profile_tables(spark: SparkSession, tables: dict[str, DataFrame], as_of: str,
                   approx: bool = True) -> DataFrame:
    """Profiles of many tables as one lazy plan, stamped for a history table."""
    parts = [profile(df, name, approx) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn("snapshot", F.lit(as_of))


def append_history(profiles: DataFrame, path: str) -> str:
    profiles.write.mode("append").partitionBy("snapshot").parquet(path)
    return path


def top_values(df: DataFrame, cols: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent values of each column.

    Counted before the ranking, and ``rank <= k`` lets Spark cut each task to
    ``k`` rows per column before they meet.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    order = W.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# Up to 18 digits, or 19 within the range of 64 bits: prefixes of 9223372036854775807 followed by a smaller digit.
_LIMIT = "9223372036854775807"
BIGINT = ("^([+-]?0*([0-9]{1,18}|" + "|".join(f"{_LIMIT[:k]}[0-{int(_LIMIT[k]) - 1}][0-9]{{{18 - k}}}" for k in range(19) if _LIMIT[k] != "0")
          + f"|{_LIMIT})|-0*9223372036854775808)$")


def type_consistency(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per text column: how many values read as integer, decimal, date-time or
    boolean. Grammars are patterns, because casts differ between engines."""
    patterns = {
        "n_bigint": BIGINT,
        "n_double": r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
        "n_timestamp": ISO_8601,
        "n_boolean": r"^(true|false|TRUE|FALSE|True|False)$",
    }
    aggs = []
    for c in cols:
        text = F.col(c).cast("string")
        aggs.append(F.count(c).alias(f"{c}__n"))
        aggs += [F.count_if(text.rlike(p)).alias(f"{c}__{k}") for k, p in patterns.items()]
    entries = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("n_values"),
        *[F.col(f"{c}__{k}").alias(k) for k in patterns],
        *[F.round(F.try_divide(F.col(f"{c}__{k}"), F.col(f"{c}__n")), 6).alias(k.replace("n_", "share_"))
          for k in patterns]) for c in cols])
    return df.agg(*aggs).select(F.inline(entries))
