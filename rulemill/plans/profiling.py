"""Queries for table profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import profile as pf
from rulemill.operators import sketches as sk
from rulemill.plans.catalog import query
from rulemill.session import shared_dir
from rulemill.functions.text import ISO_8601
from rulemill.sources.tables import load


def profile_sql(table: str, columns: dict[str, str]) -> str:
    """Profile rows per column; kinds are int, double, text, time and array, of which only nulls are counted."""
    shown = {"int": "CAST({f} AS VARCHAR)", "text": "{f}",
             "double": "CAST(CAST(round({f}, 6) AS DECIMAL(30,6)) AS VARCHAR)",
             "time": "strftime({f}, '%Y-%m-%d %H:%M:%S')"}
    parts = []
    for c, kind in columns.items():
        if kind == "array":
            parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows,
            count(*) - count({c}) AS n_nulls,
            round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 6) AS null_rate,
            CAST(NULL AS BIGINT) AS n_distinct, CAST(NULL AS VARCHAR) AS min_value,
            CAST(NULL AS VARCHAR) AS max_value, CAST(NULL AS DOUBLE) AS mean FROM {table}""")
            continue
        mean = f"round(avg({c}), 4)" if kind in ("int", "double") else "CAST(NULL AS DOUBLE)"
        parts.append(f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows,
            count(*) - count({c}) AS n_nulls,
            round(CAST(count(*) - count({c}) AS DOUBLE) / count(*), 6) AS null_rate,
            count(DISTINCT {c}) AS n_distinct, {shown[kind].format(f=f'min({c})')} AS min_value,
            {shown[kind].format(f=f'max({c})')} AS max_value, {mean} AS mean FROM {table}""")
    return " UNION ALL ".join(parts)


TABLE_COLUMNS = {
    "region": {"r_regionkey": "int", "r_name": "text"},
    "nation": {"n_nationkey": "int", "n_name": "text", "n_regionkey": "int"},
    "supplier": {"s_suppkey": "int", "s_name": "text", "s_nationkey": "int", "s_acctbal": "double"},
    "customer": {"c_custkey": "int", "c_name": "text", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "text"},
    "part": {"p_partkey": "int", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "int",
             "p_retailprice": "double"},
    "orders": {"o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "text", "o_totalprice": "double",
               "o_orderdate": "time", "o_orderpriority": "text"},
    "events": {"event_id": "int", "ts": "time", "user_id": "int", "event_type": "text", "value": "double",
               "props": "text"},
    "lineitem": {"l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "text", "l_linestatus": "text", "l_shipdate": "time"},
    "documents": {"doc_id": "int", "text": "text", "lang": "text", "source": "text", "n_chars": "int"},
    "pages": {"page_id": "int", "url": "text", "html": "text"},
    "embeddings": {"vec_id": "int", "embedding": "array", "label": "int"},
    "benchmark": {"item_id": "int", "text": "text"},
    "labels": {"doc_id": "int", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "int", "turn": "int", "role": "text", "text": "text"},
}

_ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query(" UNION ALL ".join(
    f"""SELECT 'orders' AS table_name, {i} AS ordinal, '{c}' AS name, '{t}' AS type, true AS nullable,
               count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM orders"""
    for i, (c, t) in enumerate(_ORDER_TYPES)))
def schema_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    nulls = pf.profile(orders, "orders").select(F.col("column_name").alias("name"), "n_rows", "n_nulls")
    return pf.describe_schema(orders, "orders").join(nulls, "name")


_LINE_NUMS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax"]


@query(" UNION ALL ".join(
    [f"""SELECT '{c}' AS column_name, count({c}) AS cnt, round(avg({c}), 4) AS mean,
                round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min_num,
                CAST(max({c}) AS DOUBLE) AS max_num, CAST(NULL AS VARCHAR) AS min_text,
                CAST(NULL AS VARCHAR) AS max_text, round(quantile_cont({c}, 0.25), 4) AS p25,
                round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75
         FROM lineitem""" for c in _LINE_NUMS]
    + [f"""SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c}), NULL, NULL, NULL
           FROM lineitem""" for c in ("l_returnflag", "l_linestatus")]))
def summary_lineitem(spark, sf_dir):
    return pf.summarize(load(spark, sf_dir, "lineitem"), exact=True)


@query("SELECT event_id FROM events ORDER BY event_id LIMIT 5")
def sample_events(spark, sf_dir):
    return pf.sample_rows(load(spark, sf_dir, "events"), 5, ["event_id"]).select("event_id")


@query(profile_sql("customer", TABLE_COLUMNS["customer"]))
def profile_customer(spark, sf_dir):
    return pf.profile(load(spark, sf_dir, "customer"), "customer", approx=False)


@query(profile_sql("events", TABLE_COLUMNS["events"]))
def profile_events(spark, sf_dir):
    return pf.profile(load(spark, sf_dir, "events"), "events", approx=False)


@query("SELECT *, '2026-01-01' AS snapshot FROM ("
       + " UNION ALL ".join(profile_sql(t, c) for t, c in TABLE_COLUMNS.items()) + ") p")
def profile_catalog(spark, sf_dir):
    tables = {t: load(spark, sf_dir, t) for t in TABLE_COLUMNS}
    return pf.profile_tables(spark, tables, "2026-01-01", approx=False)


_TOP = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query("SELECT column_name, value, n, rank FROM (SELECT *, row_number() OVER "
       "(PARTITION BY column_name ORDER BY n DESC, value) AS rank FROM ("
       + " UNION ALL ".join(f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n
                                FROM orders GROUP BY 2""" for c in _TOP) + ") c) r WHERE rank <= 4")
def topvalues_orders(spark, sf_dir):
    return pf.top_values(load(spark, sf_dir, "orders"), _TOP, 4)


_GRAMMAR = {
    "n_double": "^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "n_timestamp": ISO_8601,
    "n_boolean": "^(true|false|TRUE|FALSE|True|False)$",
}
_MIXED = {"id_text": "CAST(event_id AS VARCHAR)", "id_long": "CAST(CAST(event_id AS HUGEINT) * 9000000000000000 AS VARCHAR)", "props": "props", "event_type": "event_type",
          "day_text": "strftime(ts, '%Y-%m-%d')", "k_text": "json_extract_string(props, '$.k')"}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({e}) AS n_values, " + ", ".join(
        f"count(*) FILTER (WHERE {test}) AS {k}, round(CAST(count(*) FILTER (WHERE {test}) AS DOUBLE) / count({e}), 6) "
        f"AS {k.replace('n_', 'share_')}" for k, test in [("n_bigint", f"TRY_CAST({e} AS BIGINT) IS NOT NULL AND regexp_matches({e}, '^[+-]?[0-9]+$')"), *(
            (k, f"regexp_matches({e}, '{g}')") for k, g in _GRAMMAR.items())]) + " FROM events"
    for c, e in _MIXED.items()))
def type_consistency_events(spark, sf_dir):
    events = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id_text"),
        (F.col("event_id").cast("decimal(38,0)") * 9000000000000000).cast("decimal(38,0)").cast("string").alias("id_long"), "props", "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        F.get_json_object("props", "$.k").alias("k_text"))
    return pf.type_consistency(events, list(_MIXED))


@query("""SELECT column_name, count(*) AS n_rows, count(*) - count(v) AS n_nulls, min(n) AS low, max(n) AS high,
                 min(CASE WHEN n IS NULL THEN v END) AS low_text, max(CASE WHEN n IS NULL THEN v END) AS high_text, round(avg(n), 4) AS mean,
                 true AS distinct_close, true AS median_close
          FROM (SELECT 'event_type' AS column_name, event_type AS v, CAST(NULL AS DOUBLE) AS n FROM events
                UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), CAST(user_id AS DOUBLE) FROM events
                UNION ALL SELECT 'value', CAST(value AS VARCHAR), value FROM events) t GROUP BY 1""")
def profile_history(spark, sf_dir):
    """The events profiled day by day, the last day appended twice; days merged without the table, then held against it."""
    e, path = load(spark, sf_dir, "events").select("event_type", "user_id", "value", "ts"), shared_dir(spark, "profile-history")
    day, last = F.date_format("ts", "yyyy-MM-dd"), e.agg(F.max("ts")).scalar()
    days = lambda df: sk.sketch(df, "events", day).where("column_name <> 'ts'")
    sk.append_sketches(days(e.where(F.to_date("ts") < F.to_date(last))), path)
    for _ in range(2):
        sk.append_sketches(days(e.where(F.to_date("ts") == F.to_date(last))), path)
    merged = sk.merged_profile(sk.read_sketches(spark, path))
    exact = e.agg(*[F.count_distinct(c).alias(c) for c in ("event_type", "user_id", "value")]).select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact")) for c in ("event_type", "user_id", "value")])))
    median = {c: merged.where(F.col("column_name") == c).agg(F.max("p50")).scalar() for c in ("user_id", "value")}
    around = e.agg(*[x for c, m in median.items() for x in (
        F.count_if(F.col(c) < m).alias(f"{c}_below"), F.count_if(F.col(c) <= m).alias(f"{c}_upto"), F.count(c).alias(f"{c}_n"))])
    ranks = around.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), ((F.col(f"{c}_below") <= (0.5 + sk.RANK_ERROR) * F.col(f"{c}_n")) & (F.col(f"{c}_upto") >= (0.5 - sk.RANK_ERROR) * F.col(f"{c}_n"))).alias("near"))
        for c in ("user_id", "value")])))
    close = F.abs(F.col("n_distinct") - F.col("exact")) <= sk.DISTINCT_ERROR * F.col("exact") + 1
    return merged.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", "low", "high", "low_text", "high_text", "mean", close.alias("distinct_close"), F.coalesce("near", F.lit(True)).alias("median_close"))
