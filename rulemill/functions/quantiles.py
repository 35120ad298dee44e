"""Exact quantiles without a whole column in one task or buffer.

Equal values of a group are counted first and dealt by even ranges of (group, value).
The totals of a group's ranges - one number for each - tell which of them hold the wanted
ranks; only those ranges are sorted and added up, and the ranks read off. One path for every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rulemill.session import checkpointed


def melt_numeric(df: DataFrame, cols: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Rows (by..., column_name, value) of the non-null values, as doubles."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"),
                               F.col(f"`{c}`").cast("double").alias("value")) for c in cols])
    return (df.select(*by, F.explode(pairs).alias("_p"))
            .select(*by, "_p.column_name", "_p.value")
            .where(F.col("value").isNotNull()))


def _ranges(long: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct values of each group with their counts, written in parts: even ranges of (group, value) in order.
    Groups are ``_g``, a struct, in which nulls are values like others; NaN sorts last."""
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_n"))
    parts = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = counts.select(F.struct(*keys).alias("_g"), "value", "_n").repartitionByRange(parts, "_g", "value")
    return checkpointed(cut.withColumn("_part", F.spark_partition_id()), "quantiles")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Rows (by..., column_name, prob, value) with linear interpolation.

    Every group has a row for each column and probability; the value is null where the
    group has none that is not null. A null key is a group. Of no rows at all
    there are rows only without ``by``.
    """
    keys = [*by, "column_name"]
    cut = _ranges(melt_numeric(df, cols, by), keys)
    # A group's values in order of its parts: the totals of the parts tell which of them hold the wanted ranks.
    totals = cut.groupBy("_g", "_part").agg(F.sum("_n").alias("_total"))
    whole = W.partitionBy("_g")
    before = F.coalesce(F.sum("_total").over(whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranged = totals.select("_g", "_part", "_total", before.alias("_from"), F.sum("_total").over(whole).alias("_all"))
    place = [F.lit(float(p)) * (F.col("_all") - 1) for p in probs]
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), r.alias("rank")) for i, p in enumerate(place) for r in (F.floor(p), F.ceil(p))])
    held = F.filter(wanted, lambda w: (w["rank"] >= F.col("_from")) & (w["rank"] < F.col("_from") + F.col("_total")))
    asked = ranged.select(F.col("_g").alias("_h"), F.col("_part").alias("_p"), "_from", "_all", held.alias("_held")).where(F.size("_held") > 0)
    # Only these parts are sorted.
    mine = cut.join(asked, (F.col("_g") == F.col("_h")) & (F.col("_part") == F.col("_p")))
    own = W.partitionBy("_g", "_part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    stop = F.col("_from") + F.sum("_n").over(own)
    spans = mine.select("_g", "_all", "value", "_held", "_n", stop.alias("_stop"))
    hit = F.filter("_held", lambda w: (w["rank"] >= F.col("_stop") - F.col("_n")) & (w["rank"] < F.col("_stop")))
    found = spans.select("_g", "_all", "value", F.explode(hit).alias("w"))
    ends = found.groupBy("_g", F.col("w.i").alias("i")).agg(
        F.min("_all").alias("_all"), F.min(F.struct("w.rank", "value")).alias("low"), F.max(F.struct("w.rank", "value")).alias("high"))
    at = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1)
    part = at * (F.col("_all") - 1) - F.floor(at * (F.col("_all") - 1))
    low, high = F.col("low.value"), F.col("high.value")
    value = F.when((part == 0) | (low == high), low).otherwise((1 - part) * low + part * high)
    values = ends.select("_g", at.alias("prob"), value.alias("value"))
    every = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob")) for c in cols for p in probs])
    every = every.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.column_name", "_c.prob")
    every = every.withColumn("_g", F.struct(*keys))
    return every.join(values, ["_g", "prob"], "left").select(*by, "column_name", "prob", "value")

