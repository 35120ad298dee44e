"""Queries for rules derived from schemas and mined from data."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import mining as mi
from rulemill.operators.evaluate import evaluate
from rulemill.plans.catalog import query
from rulemill.plans.sales_sql import counts_sql, injected_sql
from rulemill.sources.sales import SALES_DEFECTS, SALES_KEYS, SALES_SCHEMA, inject, sales_view
from rulemill.sources.tables import load

_COUNTS = ["rule_id", "rule", "n_rows", "passed", "failed", "unknown"]


def _rule_counts_sql(relation, rules):
    return " UNION ALL ".join(
        f"SELECT '{i}' AS rule_id, '{text}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE {text}) AS passed, "
        f"count(*) FILTER (WHERE NOT ({text})) AS failed, count(*) FILTER (WHERE ({text}) IS NULL) AS unknown "
        f"FROM {relation}" for i, text in rules.items())


def _injected(spark, sf_dir):
    return inject(sales_view(spark, sf_dir, ordered_dates=True), SALES_KEYS, SALES_DEFECTS)


@query(_rule_counts_sql(f"({injected_sql()}) s", {
    "not_null_transaction_id": "transaction_id IS NOT NULL", "not_null_status": "status IS NOT NULL"}))
def rules_not_null(spark, sf_dir):
    rules = mi.rules_not_null(SALES_SCHEMA, contract=["status"])
    return evaluate(_injected(spark, sf_dir), rules).select(*_COUNTS)


_NUMERIC = ["amount", "original_price", "discount_price", "quantity"]


@query("SELECT *, 'default' AS form FROM (" + _rule_counts_sql(f"({injected_sql()}) s", {
    f"numeric_{c}": f"{c} IS NULL OR {c} >= 0" for c in _NUMERIC}) + ") d UNION ALL SELECT *, 'reference' FROM ("
    + _rule_counts_sql(f"({injected_sql()}) s", {
        f"numeric_{c}": f"{c} IS NOT NULL OR {c} >= 0" for c in _NUMERIC}) + ") r")
def rules_numeric(spark, sf_dir):
    df = _injected(spark, sf_dir)
    parts = [evaluate(df, mi.rules_numeric(SALES_SCHEMA, form)).select(*_COUNTS, F.lit(form).alias("form"))
             for form in ("default", "reference")]
    return parts[0].unionByName(parts[1])


def _outlier_sql(table, cols, bounds):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(lo, 4) AS lo, round(hi, 4) AS hi, count({c}) AS n_values,
                   count(*) FILTER (WHERE {c} < lo) AS n_below, count(*) FILTER (WHERE {c} > hi) AS n_above
            FROM {table}, (SELECT {bounds.format(c=c)} FROM {table}) b GROUP BY lo, hi""" for c in cols)


@query(_outlier_sql("events", ["value", "user_id"], """
    quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
    quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi"""))
def outliers_iqr_events(spark, sf_dir):
    return mi.mine_outliers(load(spark, sf_dir, "events"), ["value", "user_id"], 1.5, "iqr")


@query(_outlier_sql("part", ["p_size", "p_retailprice"],
                    "avg({c}) - 1.5 * stddev_samp({c}) AS lo, avg({c}) + 1.5 * stddev_samp({c}) AS hi"))
def outliers_z_part(spark, sf_dir):
    return mi.mine_outliers(load(spark, sf_dir, "part"), ["p_size", "p_retailprice"], 1.5, "zscore")


_PAIR_COLS = {"number": ["amount", "original_price", "discount_price", "quantity"],
              "time": ["order_date", "ship_date"]}
_PAIRS = [(a, b) for g in _PAIR_COLS.values() for a in g for b in g if a != b]


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{a}' AS left_column, '{b}' AS right_column, '{a} <= {b}' AS rule, count(*) FILTER (
               WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n_pairs,
               round(CAST(count(*) FILTER (WHERE {a} <= {b}) AS DOUBLE)
                     / count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL), 6) AS support,
               '_cross_column' AS "column" FROM ({injected_sql()}) s""" for a, b in _PAIRS)
    + ") t WHERE support >= 0.9")
def order_pairs_sales(spark, sf_dir):
    df = _injected(spark, sf_dir)
    return mi.mine_order_pairs(df, mi.same_type_pairs(df, exclude=tuple(SALES_KEYS)), 0.9)


_TRIPLES = [("original_price", "quantity", "amount"), ("discount_price", "quantity", "amount")]


@query(" UNION ALL ".join(
    f"""SELECT 'abs({a} * {b} - {c}) <= 0.01' AS rule, count(*) AS n_rows,
               round(CAST(count(*) FILTER (WHERE abs({a} * {b} - {c}) <= 0.01) AS DOUBLE) / count(*), 6) AS support
        FROM ({injected_sql()}) s""" for a, b, c in _TRIPLES))
def product_rule_sales(spark, sf_dir):
    return mi.mine_products(_injected(spark, sf_dir), _TRIPLES, 0.01)


def _format_sql(table, col, k):
    shape = f"regexp_replace(regexp_replace({col}, '[A-Za-z]', 'A', 'g'), '[0-9]', '9', 'g')"
    regex = (r"'^' || regexp_replace(regexp_replace(regexp_replace(shape, '([^A-Za-z0-9 ])', '\\\1', 'g'),"
             r" 'A', '[A-Za-z]', 'g'), '9', '[0-9]', 'g') || '$'")
    return f"""SELECT '{col}' AS column_name, shape, n, {regex} AS regex FROM (
               SELECT {shape} AS shape, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY 1
               ORDER BY 2 DESC, 1 LIMIT {k}) t"""


@query(" UNION ALL ".join(f"SELECT * FROM ({_format_sql(t, c, 5)}) x" for t, c in (
    ("customer", "c_name"), ("part", "p_name"), ("orders", "o_orderpriority"))))
def formats_customer(spark, sf_dir):
    parts = [mi.mine_formats(load(spark, sf_dir, t), c, 5) for t, c in (
        ("customer", "c_name"), ("part", "p_name"), ("orders", "o_orderpriority"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT column_name, n_values, n_rows, rule FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n_values, CAST(sum(n) AS BIGINT) AS n_rows,
               '{c} IN (' || string_agg('''' || v || '''', ', ' ORDER BY v) || ')' AS rule
        FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM orders GROUP BY 1) g"""
    for c in ("o_orderstatus", "o_orderpriority", "o_orderkey")) + ") t WHERE n_values <= 20")
def enums_orders(spark, sf_dir):
    return mi.mine_enums(load(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority", "o_orderkey"], 20)


_RANGE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, 0.0 AS q, min({c}) AS lo, max({c}) AS hi FROM lineitem UNION ALL
        SELECT '{c}', 0.01, round(quantile_cont({c}, 0.01), 4), round(quantile_cont({c}, 0.99), 4) FROM lineitem"""
    for c in _RANGE_COLS))
def ranges_lineitem(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    full = mi.mine_ranges(li, _RANGE_COLS).withColumn("q", F.lit(0.0))
    return full.unionByName(mi.mine_ranges(li, _RANGE_COLS, 0.01).withColumn("q", F.lit(0.01)))


@query("SELECT * FROM (" + counts_sql("events", {
    "range_user_id": "user_id BETWEEN lo_user_id AND hi_user_id",
    "range_value": "value BETWEEN lo_value AND hi_value"}).replace(
        "FROM events", """FROM events, (SELECT
            round(quantile_cont(value, 0.25) - 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)), 4) AS lo_value,
            round(quantile_cont(value, 0.75) + 1.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)), 4) AS hi_value,
            round(quantile_cont(user_id, 0.25) - 1.5 * (quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25)), 4) AS lo_user_id,
            round(quantile_cont(user_id, 0.75) + 1.5 * (quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25)), 4) AS hi_user_id
            FROM events) b""") + ") t")
def mined_rules_evaluated(spark, sf_dir):
    """Mined bounds become rules, and the rules are evaluated."""
    events = load(spark, sf_dir, "events")
    rules = mi.outlier_rules(mi.mine_outliers(events, ["value", "user_id"]))
    return evaluate(events, rules).select("rule_id", "n_rows", "passed", "failed", "unknown", "pass_rate")


@query(r"""WITH v AS (SELECT lower(substr(user_agent, 1, 1)) || user_agent AS t FROM (
                  SELECT CASE WHEN event_id % 5 = 0 THEN event_type || '-' || user_id ELSE 'é' || value || '/' || event_type END AS user_agent FROM events) e),
                s AS (SELECT regexp_replace(regexp_replace(t, '\p{L}', 'A', 'g'), '\p{Nd}', '9', 'g') AS shape, count(*) AS n FROM v GROUP BY 1),
                m AS (SELECT *, regexp_replace(regexp_replace(shape, 'A+', 'A', 'g'), '9+', '9', 'g') AS pattern FROM s),
                top AS (SELECT pattern, CAST(sum(n) AS BIGINT) AS n, round(sum(n) / (SELECT sum(n) FROM s), 6) AS coverage FROM m GROUP BY 1 ORDER BY n DESC, pattern LIMIT 4),
                r AS (SELECT pattern, unnest(regexp_extract_all(shape, 'A+|9+|[^A9]')) AS run, generate_subscripts(regexp_extract_all(shape, 'A+|9+|[^A9]'), 1) AS at_
                      FROM m WHERE pattern IN (SELECT pattern FROM top)),
                l AS (SELECT pattern, at_, min(length(run)) AS lo, max(length(run)) AS hi, any_value(left(run, 1)) AS kind FROM r GROUP BY 1, 2),
                p AS (SELECT pattern, at_, CASE kind WHEN 'A' THEN '\p{L}' WHEN '9' THEN '\p{Nd}' ELSE '\' || kind END
                             || CASE WHEN kind NOT IN ('A', '9') OR hi = 1 THEN '' WHEN lo = hi THEN '{' || lo || '}' ELSE '{' || lo || ',' || hi || '}' END AS piece FROM l),
                x AS (SELECT pattern, string_agg(piece, '' ORDER BY at_) AS regex FROM p GROUP BY 1)
           SELECT 't' AS column_name, pattern, '^' || regex || '\z' AS regex, n, coverage FROM top JOIN x USING (pattern)""")
def patterns_events(spark, sf_dir):
    text = F.when(F.col("event_id") % 5 == 0, F.concat_ws("-", "event_type", F.col("user_id").cast("string"))).otherwise(
        F.concat(F.lit("é"), F.col("value").cast("string"), F.lit("/"), "event_type"))
    e = load(spark, sf_dir, "events").withColumn("t", F.concat(F.lower(F.substring(text, 1, 1)), text))
    return mi.mine_patterns(e, "t", 4)
