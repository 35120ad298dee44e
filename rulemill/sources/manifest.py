"""Delivery-manifest schema, a typed literal table for tests, and a derived manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.sources.tables import load

# Manifest schema (arrival dates are kept as text).
MANIFEST_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("estimated_arrival_date", T.StringType(), True),
    T.StructField("supplier_id", T.StringType(), True),
    T.StructField("is_inspected", T.BooleanType(), True),
])


def manifest_df(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A typed table from literal rows."""
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def manifest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest derived from every line item, with the defect kinds the
    manifest rules look for: odd products, zero and missing quantities,
    slash dates, date-only values and missing products."""
    li = load(spark, sf_dir, "lineitem")
    part = F.col("l_partkey")
    product = (F.when(part % 19 == 0, F.lit(None))
               .when(part % 23 == 0, F.concat(F.lit("XX-P-"), F.lpad(part.cast("string"), 7, "0")))
               .when(part % 2 == 0, F.concat(F.lit("CW-P-"), F.lpad(part.cast("string"), 7, "0")))
               .otherwise(F.concat(F.lit("CW-T-"), F.lpad(part.cast("string"), 7, "0"))))
    qty = (F.when(part % 13 == 0, F.lit(None))
           .when(part % 17 == 0, F.lit(0))
           .otherwise(F.col("l_quantity").cast("int")))
    iso_day = F.date_format("l_shipdate", "yyyy-MM-dd")
    arrival = (F.when(part % 11 == 0, F.date_format("l_shipdate", "yyyy/MM/dd"))
               .when(part % 5 == 0, iso_day)
               .otherwise(F.concat(iso_day, F.lit("T14:00:00Z"))))
    return li.select(
        product.alias("product_id"),
        qty.cast("int").alias("quantity"),
        arrival.alias("estimated_arrival_date"),
        F.concat(F.lit("SUP-"), F.lpad(F.col("l_suppkey").cast("string"), 3, "0")).alias("supplier_id"),
        (F.col("l_returnflag") == "A").alias("is_inspected"),
    )
