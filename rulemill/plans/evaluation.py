"""Queries for sources, rule evaluation and streaming validation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rulemill.functions.rules import CROSS_COLUMN, PARSE_ERROR, Rule
from rulemill.functions.screening import screening_report
from rulemill.operators import evaluate as ev
from rulemill.operators import mutation
from rulemill.operators.mining import check_reference, check_unique, phrase_rules
from rulemill.plans.catalog import query
from rulemill.plans.sales_sql import (
    SALES_RULES, SALES_RULES_SQL, counts_sql, failed_text_sql, injected_sql, sales_sql)
from rulemill.functions.text import ISO_8601
from rulemill.session import shared_dir
from rulemill.sources.manifest import manifest_df, manifest_view
from rulemill.sources.payload_log import append_log, read_log
from rulemill.sources.sales import SALES_DEFECTS, SALES_KEYS, inject, sales_view
from rulemill.sources.tables import load, load_file, preview, save
from rulemill.streaming.validate import read_stream, validate_stream

_SALES_OUT = """transaction_id, customer_email, amount, original_price, discount_price, quantity,
    CAST(order_date AS VARCHAR) AS order_date, CAST(ship_date AS VARCHAR) AS ship_date, status, payment_method"""


def _dates_as_text(df):
    return df.withColumns({c: F.col(c).cast("string") for c in ("order_date", "ship_date")})


def _injected(spark, sf_dir):
    return inject(sales_view(spark, sf_dir, ordered_dates=True), SALES_KEYS, SALES_DEFECTS)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def preview_orders(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return preview(orders, 20, ["o_orderkey"])


@query(f"SELECT {_SALES_OUT} FROM ({sales_sql()}) s", name="sales_view")
def sales_view_rows(spark, sf_dir):
    return _dates_as_text(sales_view(spark, sf_dir).drop(*SALES_KEYS))


@query(f"SELECT {_SALES_OUT}, defects FROM ({injected_sql()}) s")
def inject_sales(spark, sf_dir):
    return _dates_as_text(_injected(spark, sf_dir).drop(*SALES_KEYS))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows, min(event_id) AS first_id,
                 max(event_id) AS last_id FROM events GROUP BY 1""")
def append_payload_log(spark, sf_dir):
    path = shared_dir(spark, "payload-log")
    append_log(load(spark, sf_dir, "events"), path)
    return (read_log(spark, path).groupBy(F.col("day").cast("string").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"),
                 F.max("event_id").alias("last_id")))


@query("SELECT n_regionkey, count(*) AS n_rows, min(n_name) AS first_name FROM nation GROUP BY 1")
def saved_table(spark, sf_dir):
    """Nations saved as a managed table of a database of this run, partitioned, and loaded by name."""
    database = f"rulemill_{uuid.uuid4().hex}"
    save(load(spark, sf_dir, "nation"), database, "nation", partition_by=("n_regionkey",))
    return load(spark, database, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n_rows"), F.min("n_name").alias("first_name"))


@query("""SELECT 'csv' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS word FROM customer
          UNION ALL SELECT 'json', CAST(n_nationkey AS VARCHAR), n_name FROM nation""")
def files_loaded(spark, sf_dir):
    """Customers written as CSV and nations as JSON, loaded by suffix."""
    out, customer, nation = shared_dir(spark, "files"), load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    customer.select("c_custkey", "c_mktsegment").write.csv(f"{out}/customer.csv", header=True)
    nation.select(F.to_json(F.struct("n_nationkey", "n_name"), {"pretty": "true"}).alias("value")).repartition("value").write.option("maxRecordsPerFile", 1).text(f"{out}/nation.json")
    csv = load_file(spark, f"{out}/customer.csv").select(F.lit("csv").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("word"))
    json = load_file(spark, f"{out}/nation.json").select(F.lit("json").alias("kind"), F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("word"))
    return csv.unionByName(json)


_COUNTS = ["rule_id", "n_rows", "passed", "failed", "unknown", "pass_rate"]


@query(counts_sql(f"({sales_sql()}) s", SALES_RULES_SQL))
def violations_sales(spark, sf_dir):
    return ev.evaluate(sales_view(spark, sf_dir), SALES_RULES).select(*_COUNTS)


@query(counts_sql(f"({injected_sql()}) s", SALES_RULES_SQL))
def violations_injected(spark, sf_dir):
    return ev.evaluate(_injected(spark, sf_dir), SALES_RULES).select(*_COUNTS)


_EVENT_RULES = {
    "value_capped": "value <= 100",
    "type_known": "event_type IN ('view', 'click', 'purchase', 'signup')",
    "early_month": "ts < TIMESTAMP '2024-01-20 00:00:00'",
    "id_present": "event_id IS NOT NULL",
    "big_when_bought": "event_type <> 'purchase' OR value > 5",
}


@query(counts_sql("events", _EVENT_RULES))
def violations_events(spark, sf_dir):
    rules = [Rule(k, CROSS_COLUMN, v.replace("TIMESTAMP ", "TIMESTAMP_NTZ ")) for k, v in _EVENT_RULES.items()]
    return ev.evaluate(load(spark, sf_dir, "events"), rules).select(*_COUNTS)


_CUSTOMER_RULES = {
    "balance_not_negative": "c_acctbal >= 0",
    "segment_known": "c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')",
    "nation_range": "c_nationkey BETWEEN 0 AND 20",
}


@query(counts_sql("customer", _CUSTOMER_RULES))
def violations_customer(spark, sf_dir):
    rules = [Rule(k, CROSS_COLUMN, v) for k, v in _CUSTOMER_RULES.items()]
    return ev.evaluate(load(spark, sf_dir, "customer"), rules).select(*_COUNTS)


def line_rules(n: int) -> list[Rule]:
    """``n`` two-term predicates over lineitem, to exercise batches."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    scale = {"l_quantity": 1.0, "l_extendedprice": 2000.0, "l_discount": 0.002, "l_tax": 0.0016}
    out = []
    for i in range(n):
        a, b = columns[i % 4], columns[(i + 1 + i // 4) % 4]
        out.append(Rule(f"r{i:03d}", CROSS_COLUMN,
                        f"{a} >= {scale[a] * (i % 25):.4f} OR {b} < {scale[b] * (i % 40):.4f}"))
    return out


@query(counts_sql("lineitem", {r.rule_id: r.rule for r in line_rules(120)}))
def violations_many_rules(spark, sf_dir):
    return ev.evaluate(load(spark, sf_dir, "lineitem"), line_rules(120)).select(*_COUNTS)


@query(f"""SELECT transaction_id, order_key, part_key, line_number, {failed_text_sql(SALES_RULES_SQL)} AS failed_rules
           FROM ({injected_sql()}) s""")
def tagged_sales(spark, sf_dir):
    return ev.tag(_injected(spark, sf_dir), SALES_RULES).select(
        "transaction_id", "order_key", "part_key", "line_number", "failed_rules")


_SPLIT = f"SELECT *, {failed_text_sql(SALES_RULES_SQL)} AS failed_rules FROM ({injected_sql()}) s"


@query(f"SELECT transaction_id, amount, quantity, failed_rules FROM ({_SPLIT}) t WHERE failed_rules <> ''")
def quarantine_sales(spark, sf_dir):
    return ev.split(_injected(spark, sf_dir), SALES_RULES)[1].select(
        "transaction_id", "amount", "quantity", "failed_rules")


@query(f"SELECT transaction_id, amount, quantity FROM ({_SPLIT}) t WHERE failed_rules = ''")
def silver_sales(spark, sf_dir):
    return ev.split(_injected(spark, sf_dir), SALES_RULES)[0].select("transaction_id", "amount", "quantity")


@query(f"""SELECT CASE WHEN failed_rules = '' THEN 'clean' ELSE 'quarantine' END AS outcome,
                  count(*) AS n_rows, CAST(sum(quantity) AS BIGINT) AS total_quantity
           FROM ({_SPLIT}) t GROUP BY 1""")
def split_written_once(spark, sf_dir):
    path = ev.write_split(_injected(spark, sf_dir), SALES_RULES, shared_dir(spark, "split"))
    return spark.read.parquet(path).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("total_quantity"))


CANDIDATES = [
    Rule("c01", "amount", "amount > 0", "llm"),
    Rule("c02", "customer_email", SALES_RULES[3].rule, "llm"),
    Rule("c03", CROSS_COLUMN, "ship_date >= order_date", "llm"),
    Rule("c04", "status", "status IN ('completed', 'pending')", "llm"),
    Rule("c05", "quantity", "quantity >= 0 AND quantity < 1000000", "llm"),
    Rule("c06", "email", "email RLIKE 'x'", "llm"),
    Rule("c07", CROSS_COLUMN, "end_date >= start_date", "llm"),
    Rule("c08", "quantity", "sum(quantity) > 0", "llm"),
    Rule("c09", "quantity", "quantity > (SELECT 1)", "llm"),
    Rule("c10", "quantity", "reflect('java.lang.Math', 'abs', quantity) = '1'", "llm"),
    Rule("c11", "status", "status > 5", "llm"),
    Rule("c12", "quantity", "quantity + 1", "llm"),
    Rule("c13", "quantity", "amount / quantity > 1", "llm"),
    Rule("c14", "status", "status = 'a' -- always", "llm"),
    Rule("c15", "order_date", "order_date <= current_date()", "llm"),
    Rule("c16", PARSE_ERROR, "no rules today", "llm"),
    Rule("c17", "quantity", "", "llm"),
    Rule("c18", "quantity", "quantity BETWEEN 1 AND 50", "llm"),
    Rule("c19", "order_date", "order_date >= '1996-01-01'", "llm"),
    Rule("c20", CROSS_COLUMN, "coalesce(discount_price, 0) <= original_price", "llm"),
    Rule("c21", "status", "lower(status) > 5", "llm"),
    Rule("c22", "status", "coalesce(status, 0) > 1", "llm"),
    Rule("c23", "status", "substring(status, 1, 1) = 3", "llm"),
    Rule("c24", "status", "status RLIKE '[a'", "llm"),
    Rule("c25", "status", "status RLIKE concat('(', status)", "llm"),
    Rule("c26", "quantity", "quantity < 1e3", "llm"),
]
_ACCEPTED_SQL = {
    "c01": SALES_RULES_SQL["amount_positive"], "c02": SALES_RULES_SQL["email_format"],
    "c03": SALES_RULES_SQL["ship_after_order"], "c04": "status IN ('completed', 'pending')",
    "c05": SALES_RULES_SQL["quantity_range"], "c18": "quantity BETWEEN 1 AND 50",
    "c19": "order_date >= DATE '1996-01-01'", "c20": "coalesce(discount_price, 0) <= original_price",
    "c26": "quantity < 1000",
}
_REJECTED = {
    "c06": "unknown column: email", "c07": "unknown column: end_date", "c08": "function not allowed: sum",
    "c09": "unknown column: SELECT", "c10": "function not allowed: reflect", "c11": "compares text with number",
    "c12": "not Boolean", "c13": "character not allowed", "c14": "comment or escaped quote",
    "c15": "function not allowed: current_date", "c16": "parse error", "c17": "empty rule",
    "c21": "compares text with number", "c22": "mixes number and text", "c23": "compares text with number",
    "c24": "malformed pattern", "c25": "pattern is not a literal",
}


@query(f"""SELECT rule_id, 'accepted' AS verdict, '' AS reason, passed, failed, unknown
           FROM ({counts_sql(f"({injected_sql()}) s", _ACCEPTED_SQL)}) t UNION ALL """
       + " UNION ALL ".join(f"SELECT '{k}', 'rejected', '{v}', 0, 0, 0" for k, v in _REJECTED.items()))
def screen_rules(spark, sf_dir):
    return screening_report(_injected(spark, sf_dir), CANDIDATES, ev.evaluate)


def _scorecard_check():
    counts = counts_sql(f"({sales_sql()}) s", SALES_RULES_SQL)
    return f"""SELECT 'sales' AS table_name, CAST(10 AS BIGINT) AS n_columns, CAST(8 AS BIGINT) AS covered_columns,
                      0.8 AS rule_coverage, count(*) AS n_rules, CAST(sum(failed) AS BIGINT) AS violations,
                      round(avg(pass_rate), 4) AS mean_pass_rate FROM ({counts}) t"""


@query(_scorecard_check())
def scorecard_sales(spark, sf_dir):
    return ev.scorecard(sales_view(spark, sf_dir).drop(*SALES_KEYS), SALES_RULES, "sales")


ALL = "'ALL'"


def _by_status_check():
    parts = []
    for key in ("coalesce(status, 'none')", ALL):
        for rid, p in SALES_RULES_SQL.items():
            parts.append(
                f"SELECT '{rid}' AS rule_id, {key} AS status, {int(key == ALL)} AS level, count(*) AS n_rows, "
                f"count(*) FILTER (WHERE {p}) AS passed, count(*) FILTER (WHERE NOT ({p})) AS failed, "
                f"count(*) FILTER (WHERE ({p}) IS NULL) AS unknown, "
                f"round(CAST(count(*) FILTER (WHERE NOT ({p})) AS DOUBLE) / count(*), 6) AS violation_rate "
                "FROM inj GROUP BY 1, 2")
    return f"WITH inj AS ({injected_sql()}) " + " UNION ALL ".join(parts)


@query(_by_status_check())
def violations_by_status(spark, sf_dir):
    return (ev.evaluate_by(_injected(spark, sf_dir), SALES_RULES, ["status"], totals=True)
            .withColumn("status", F.coalesce("status", F.lit("none"))))


_CAUGHT_BY = {
    "ship_before_order": "ship_after_order", "discount_above_price": "discount_le_price",
    "negative_quantity": "quantity_range", "null_status": "status_present", "malformed_email": "email_format",
}


@query(" UNION ALL ".join(
    f"""SELECT '{d}' AS defect, '{r}' AS rule_id, count(*) FILTER (WHERE p) AS planted,
               count(*) FILTER (WHERE p AND c) AS caught, count(*) FILTER (WHERE p AND NOT c) AS missed,
               count(*) FILTER (WHERE NOT p AND c) AS unplanned,
               round(CAST(count(*) FILTER (WHERE p AND c) AS DOUBLE) / count(*) FILTER (WHERE p), 6) AS recall
        FROM (SELECT list_contains(string_split(defects, ','), '{d}') AS p,
                     coalesce(NOT ({SALES_RULES_SQL[r]}), false) AS c FROM ({injected_sql()}) s) t"""
    for d, r in _CAUGHT_BY.items()))
def defect_recall(spark, sf_dir):
    return ev.recall(_injected(spark, sf_dir), SALES_RULES, _CAUGHT_BY)


# Rules that both engines read alike, changed one place at a time.
_MUTATED = [
    Rule("quantity", "quantity", "quantity BETWEEN 1 AND 50"),
    Rule("price", CROSS_COLUMN, "discount_price IS NULL OR discount_price <= original_price"),
    Rule("status", "status", "status IN ('completed', 'pending', 'shipped')"),
    Rule("dates", CROSS_COLUMN, "ship_date >= order_date AND NOT (amount <= 0)"),
    Rule("amount", "amount", "amount > 0 AND (quantity > 1 OR amount < 90000)"),
]


def _mutants_check():
    parts = [
        f"""SELECT '{m.rule_id}' AS rule_id, '{m.mutant_id}' AS mutant_id, '{m.change}' AS change, '{m.rule.replace("'", "''")}' AS mutant, label,
                   count(*) AS n_rows, count(*) FILTER (WHERE ({r.rule}) IS DISTINCT FROM ({m.rule.replace("`", '"')})) AS n_killing FROM inj GROUP BY label"""
        for r in _MUTATED for m in mutation.mutants(r)]
    return f"WITH inj AS (SELECT *, coalesce(nullif(defects, ''), 'none') AS label FROM ({injected_sql()}) s) " + " UNION ALL ".join(parts)


@query(_mutants_check())
def rule_mutants(spark, sf_dir):
    return mutation.kill_matrix(_injected(spark, sf_dir), _MUTATED, F.coalesce(F.nullif("defects", F.lit("")), F.lit("none")))


@query(f"""WITH each AS (SELECT rule_id, mutant_id, sum(n_killing) AS n FROM ({_mutants_check()}) m GROUP BY 1, 2)
           SELECT rule_id, count(*) AS n_mutants, count(*) FILTER (WHERE n > 0) AS n_killed,
                  round(avg(CASE WHEN n > 0 THEN 1 ELSE 0 END), 6) AS score,
                  coalesce(string_agg(mutant_id, ',' ORDER BY mutant_id) FILTER (WHERE n = 0), '') AS survivors
           FROM each GROUP BY 1""")
def mutation_score(spark, sf_dir):
    return mutation.mutation_score(rule_mutants(spark, sf_dir))


# The phrase rules of the manifest, plus a strict shape rule.
MANIFEST_PHRASES = [
    ("product_id", ["is not null", "starts with CW-", "matches ^CW-[PT]-[0-9]{7}$"]),
    ("quantity", ["is not null", "must be > 0"]),
    ("estimated_arrival_date", ["is not null", "is a valid ISO 8601 timestamp", "is not in the past"]),
]
_MANIFEST_SQL = """
    SELECT CASE WHEN l_partkey % 19 = 0 THEN NULL
                WHEN l_partkey % 23 = 0 THEN 'XX-P-' || lpad(CAST(l_partkey AS VARCHAR), 7, '0')
                WHEN l_partkey % 2 = 0 THEN 'CW-P-' || lpad(CAST(l_partkey AS VARCHAR), 7, '0')
                ELSE 'CW-T-' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') END AS product_id,
           CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN 0
                ELSE CAST(l_quantity AS INTEGER) END AS quantity,
           CASE WHEN l_partkey % 11 = 0 THEN strftime(l_shipdate, '%Y/%m/%d')
                WHEN l_partkey % 5 = 0 THEN strftime(l_shipdate, '%Y-%m-%d')
                ELSE strftime(l_shipdate, '%Y-%m-%d') || 'T14:00:00Z' END AS estimated_arrival_date
    FROM lineitem"""
_ISO_SQL = f"regexp_matches(estimated_arrival_date, '{ISO_8601}')"
_MANIFEST_RULES_SQL = {
    "product_id_1": "product_id IS NOT NULL",
    "product_id_2": "starts_with(product_id, 'CW-')",
    "product_id_3": "regexp_matches(product_id, '^CW-[PT]-[0-9]{7}$')",
    "quantity_1": "quantity IS NOT NULL",
    "quantity_2": "quantity > 0",
    "estimated_arrival_date_1": "estimated_arrival_date IS NOT NULL",
    "estimated_arrival_date_2": _ISO_SQL,
    "estimated_arrival_date_3":
        f"CASE WHEN {_ISO_SQL} THEN TRY_CAST(substr(replace(replace(estimated_arrival_date, 'T', ' '), 'Z', ''),"
        " 1, 19) AS TIMESTAMP) >= TIMESTAMP '1998-06-15 00:00:00' END",
}


@query(counts_sql(f"({_MANIFEST_SQL}) m", _MANIFEST_RULES_SQL))
def manifest_rules(spark, sf_dir):
    rules, _ = phrase_rules(MANIFEST_PHRASES, "1998-06-15 00:00:00")
    return ev.evaluate(manifest_view(spark, sf_dir), rules).select(*_COUNTS)


@query(f"""SELECT product_id, quantity, estimated_arrival_date, count(*) AS n_rows FROM (
               SELECT * FROM ({_MANIFEST_SQL}) m ORDER BY product_id NULLS FIRST, quantity NULLS FIRST, estimated_arrival_date LIMIT 200) t
           GROUP BY 1, 2, 3""")
def manifest_typed(spark, sf_dir):
    """The first manifest rows as literals of a typed table."""
    first = manifest_view(spark, sf_dir).orderBy(F.col("product_id").asc_nulls_first(), F.col("quantity").asc_nulls_first(), "estimated_arrival_date").limit(200)
    typed = manifest_df(spark, [tuple(r) for r in first.collect()])
    return typed.groupBy("product_id", "quantity", "estimated_arrival_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT 'l_partkey' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE known) AS matched,
                 count(*) FILTER (WHERE NOT known AND l_partkey IS NOT NULL) AS orphans,
                 count(*) FILTER (WHERE l_partkey IS NULL) AS unknown,
                 count(DISTINCT l_partkey) FILTER (WHERE NOT known) AS orphan_values
          FROM (SELECT l_partkey, EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25) AS known
                FROM lineitem) t""")
def fk_lineitem_part(spark, sf_dir):
    small_parts = load(spark, sf_dir, "part").where("p_size <= 25")
    return check_reference(load(spark, sf_dir, "lineitem"), "l_partkey", small_parts, "p_partkey").counts


@query("""SELECT l_suppkey, count(*) AS n_rows FROM lineitem
          WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 3000) GROUP BY 1""")
def orphans_lineitem_supplier(spark, sf_dir):
    solvent = load(spark, sf_dir, "supplier").where("s_acctbal >= 3000")
    found = check_reference(load(spark, sf_dir, "lineitem"), "l_suppkey", solvent, "s_suppkey").orphans
    return found.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT 'l_orderkey,l_linenumber' AS key_columns, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
                 count(*) FILTER (WHERE n > 1) AS repeated_keys,
                 CAST(sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS extra_rows
          FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) t""")
def unique_lineitem(spark, sf_dir):
    return check_unique(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).counts


def _stream_rules():
    return [Rule(k, CROSS_COLUMN, v.replace("TIMESTAMP ", "TIMESTAMP_NTZ ")) for k, v in _EVENT_RULES.items()]


@query(f"""SELECT CASE WHEN failed_rules = '' THEN 'clean' ELSE 'quarantine' END AS outcome, failed_rules,
                  count(*) AS n_rows
           FROM (SELECT {failed_text_sql(_EVENT_RULES)} AS failed_rules FROM events) t GROUP BY 1, 2""")
def stream_validate_events(spark, sf_dir):
    out = shared_dir(spark, "stream-validate")
    validate_stream(read_stream(spark, sf_dir, "events"), _stream_rules(), out)
    return spark.read.parquet(f"{out}/rows").groupBy("outcome", "failed_rules").agg(
        F.count(F.lit(1)).alias("n_rows"))
