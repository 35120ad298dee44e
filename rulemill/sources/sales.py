"""The sales transaction schema, its view over the order tables, and defect injection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.sources.tables import load

# Transaction schema, statuses and payment methods.
SALES_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_email", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("original_price", T.DoubleType(), True),
    T.StructField("discount_price", T.DoubleType(), True),
    T.StructField("quantity", T.IntegerType(), True),
    T.StructField("order_date", T.DateType(), True),
    T.StructField("ship_date", T.DateType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("payment_method", T.StringType(), True),
])
STATUSES = ["completed", "pending", "cancelled", "refunded"]
PAYMENT_METHODS = ["credit_card", "debit_card", "wire_transfer", "paypal"]

# Keys kept beside the transaction columns for injection and tie-breaks.
SALES_KEYS = ["order_key", "part_key", "line_number"]


def cents(value: Column) -> Column:
    """Round to two decimals by plain double arithmetic (same in any engine)."""
    return F.floor(value * 100.0 + 0.5).cast("double") / 100.0


def sales_view(spark: SparkSession, sf_dir: str, ordered_dates: bool = False) -> DataFrame:
    """Transactions derived from lineitem, orders and customer.

    The two smaller tables meet first, so line items are shuffled once at most.
    Spark broadcasts a side only while its measured size is under its threshold;
    otherwise they meet in a sort-merge join, where AQE splits a skewed key.
    ``ordered_dates`` replaces the ship date by one that never precedes the
    order date, the clean base for defect injection.
    """
    items = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    bought = orders.join(customer, orders.o_custkey == customer.c_custkey)
    joined = items.join(bought, items.l_orderkey == bought.o_orderkey)

    order_date = F.col("o_orderdate").cast("date")
    ship_date = F.col("l_shipdate").cast("date")
    if ordered_dates:
        ship_date = F.date_add(order_date, F.pmod("l_partkey", F.lit(15)).cast("int"))
    status = (F.when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "O", "pending")
              .when(F.col("o_orderkey") % 2 == 0, "cancelled")
              .otherwise("refunded"))
    method = (F.when(F.col("o_orderpriority").startswith("1"), "credit_card")
              .when(F.col("o_orderpriority").startswith("2"), "debit_card")
              .when(F.col("o_orderpriority").startswith("3"), "wire_transfer")
              .otherwise("paypal"))
    price = F.col("l_extendedprice")
    return joined.select(
        F.concat(F.lit("TXN-"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"),
                 F.lit("-"), F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string"), F.lit("@"),
                 F.lower("c_mktsegment"), F.lit(".example")).alias("customer_email"),
        cents(price * F.col("l_quantity")).alias("amount"),
        price.alias("original_price"),
        cents(price * (1.0 - F.col("l_discount"))).alias("discount_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        order_date.alias("order_date"),
        ship_date.alias("ship_date"),
        status.alias("status"),
        method.alias("payment_method"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_linenumber").alias("line_number"),
    )


@dataclass(frozen=True)
class Defect:
    """One defect class: rows whose key arithmetic lands on ``residue`` modulo
    ``every`` get ``column`` replaced by the ``bad`` SQL expression."""

    name: str
    column: str
    bad: str
    every: int
    residue: int = 0


# About 5 % swapped dates, 3 % discounts above price, 2 % negated quantities,
# plus nulls and malformed addresses.
SALES_DEFECTS = [
    Defect("ship_before_order", "ship_date", "date_sub(order_date, 3)", 20, 7),
    Defect("discount_above_price", "discount_price", "original_price + 25.0", 33, 5),
    Defect("negative_quantity", "quantity", "-quantity", 50, 11),
    Defect("null_status", "status", "CAST(NULL AS STRING)", 40, 3),
    Defect("malformed_email", "customer_email", "replace(customer_email, '@', '#')", 25, 2),
]


def inject(df: DataFrame, key_cols: list[str], defects: list[Defect]) -> DataFrame:
    """Plant defects at known rates, chosen by integer arithmetic on the keys.

    No random numbers, so a retried task plants the same defects. The planted
    names are listed in ``defects`` (empty text for a clean row).
    """
    weights = [31, 17, 7, 3]
    key = sum((F.col(c).cast("bigint") * w for c, w in zip(key_cols, weights)), F.lit(0))
    hits = {d.name: F.pmod(key, F.lit(d.every)) == d.residue for d in defects}
    out = {c: F.col(c) for c in df.columns}
    for d in defects:
        out[d.column] = F.when(hits[d.name], F.expr(d.bad)).otherwise(out[d.column]).alias(d.column)
    labels = F.concat_ws(",", *[F.when(hits[d.name], d.name) for d in defects])
    return df.select(*[out[c] for c in df.columns], labels.alias("defects"))
