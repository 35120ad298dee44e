"""Ordered work per key without gathering a key in one task.

The rows of every key are cut into time slots: rows are counted or reduced per
(key, slot) first, the small slot table carries totals or last values forward, and
only one slot of a key is ever sorted together. Null keys are a key like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_index(df: DataFrame, keys: list[str], order: list[str], slot: Column,
                  out: str = "idx") -> DataFrame:
    """1-based position of each row within ``keys`` by ``order``.

    ``slot`` must not decrease along ``order`` (e.g. the time cut to minutes).
    Keys and slot are one struct, in which nulls are equal.
    """
    slotted = df.withColumn("_slot", slot).withColumn("_k", F.struct(*keys, "_slot"))
    sizes = slotted.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*[F.col("_k")[k] for k in keys]).orderBy(F.col("_k")["_slot"]).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_k", F.sum("_n").over(before).alias("_start"))
    ranked = slotted.withColumn("_rn", F.row_number().over(W.partitionBy("_k").orderBy(*order)))
    return (ranked.join(starts, "_k", "left")
            .withColumn(out, F.col("_rn") + F.coalesce("_start", F.lit(0)))
            .drop("_k", "_slot", "_rn", "_start"))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], ts: str, value: str,
              tie: str, slot_unit: str = "minute") -> DataFrame:
    """For each left row, the latest right ``value`` with the same keys at or
    before the left ``ts`` (NULL if none). ``tie`` orders equal right times.

    A union and two windows; no range join, so no pair blow-up.
    """
    payload = [c for c in left.columns if c not in keys and c != ts]
    lhs = left.select(
        *keys, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.lit(None).cast("bigint").alias("_tie"),
        F.struct(*[F.col(c) for c in payload]).alias("_row"),
        F.lit(None).cast(right.schema[value].dataType).alias("_value"))
    row_type = lhs.schema["_row"].dataType
    rhs = right.where(F.col(value).isNotNull()).dropna(subset=keys).select(
        *keys, F.col(ts).alias("_ts"), F.lit(0).alias("_side"), F.col(tie).cast("bigint").alias("_tie"),
        F.lit(None).cast(row_type).alias("_row"), F.col(value).alias("_value"))
    slot = F.date_trunc(slot_unit, F.col("_ts").cast("timestamp")).alias("_slot")
    both = lhs.unionByName(rhs).withColumn("_k", F.struct(*keys, slot))

    slots = both.groupBy("_k").agg(F.max(F.when(F.col("_side") == 0, F.struct("_ts", "_tie", "_value"))).alias("_last"))
    earlier = W.partitionBy(*[F.col("_k")[k] for k in keys]).orderBy(F.col("_k")["_slot"]).rowsBetween(W.unboundedPreceding, -1)
    carried = slots.select("_k", F.last("_last", ignorenulls=True).over(earlier)["_value"].alias("_carried"))

    inside = (W.partitionBy("_k").orderBy("_ts", "_side", "_tie")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    seen = both.withColumn("_seen", F.last("_value", ignorenulls=True).over(inside))
    return (seen.where(F.col("_side") == 1).join(carried, "_k", "left")
            .select(*keys, F.col("_ts").alias(ts),
                    *[F.col("_row")[c].alias(c) for c in payload],
                    F.coalesce("_seen", "_carried").alias(value)))
