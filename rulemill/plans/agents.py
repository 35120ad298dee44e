"""Queries that run the agent flows end to end with the offline clients."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import agent as ag
from rulemill.operators.evaluate import evaluate
from rulemill.operators.inference import CannedClient, SchemaEchoClient
from rulemill.plans.catalog import query
from rulemill.plans.evaluation import _MANIFEST_RULES_SQL, _MANIFEST_SQL
from rulemill.plans.sales_sql import counts_sql
from rulemill.sources.manifest import manifest_view
from rulemill.sources.tables import load

_TABLES = {
    "orders": [("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False), ("o_totalprice", True),
               ("o_orderdate", False), ("o_orderpriority", False)],
    "customer": [("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True),
                 ("c_mktsegment", False)],
    "supplier": [("s_suppkey", True), ("s_name", False), ("s_nationkey", True), ("s_acctbal", True)],
}


def _flow_sql():
    parts = []
    for t, cols in _TABLES.items():
        checks = {f"numeric_{c}": f"{c} IS NULL OR {c} >= 0" for c, number in cols if number}
        checks |= {f"llm_{i}": f"{c} IS NOT NULL" for i, (c, _) in enumerate(cols)}
        parts.append(f"""SELECT '{t}' AS table_name, rule_id, 'accepted' AS verdict, '' AS reason, passed, failed, unknown
                         FROM ({counts_sql(t, checks)}) c""")
    return " UNION ALL ".join(parts)


@query(_flow_sql())
def agent_flow(spark, sf_dir):
    """Schema to prompt to model to parsed, screened and evaluated rules."""
    tables = {t: load(spark, sf_dir, t) for t in _TABLES}
    return ag.check(tables, ag.propose(tables, SchemaEchoClient, "amount > 0"))


_MANIFEST_IDS = ["product_id_1", "product_id_2", "quantity_1", "quantity_2", *(f"estimated_arrival_date_{k}" for k in (1, 2, 3))]


@query(f"""SELECT rule_id, passed, failed, unknown FROM (
           {counts_sql(f"({_MANIFEST_SQL}) m", {k: _MANIFEST_RULES_SQL[k] for k in _MANIFEST_IDS})}) c""")
def agent_flow_manifest(spark, sf_dir):
    """A manifest described, rules proposed as phrases, compiled and evaluated."""
    manifest = manifest_view(spark, sf_dir)
    key = ["product_id", "supplier_id", "quantity", "estimated_arrival_date"]
    rules, _ = ag.propose_phrases(manifest, key, CannedClient, "1998-06-15 00:00:00")
    return evaluate(manifest, rules).select("rule_id", "passed", "failed", "unknown")


@query("""SELECT 'lineitem' AS table_name, count(*) > 0 AS has_rows, true AS names_columns, true AS has_statistics,
                 CAST(5 AS BIGINT) AS n_sample FROM lineitem""")
def describe_for_prompt(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    text = F.col("context")
    return ag.describe_for_prompt(li, ["l_orderkey", "l_partkey", "l_linenumber"]).select(
        F.lit("lineitem").alias("table_name"), (F.length(text) > 0).alias("has_rows"),
        text.contains("l_orderkey: bigint").alias("names_columns"),
        text.contains('"summary":"75%"').alias("has_statistics"),
        F.size(F.split(F.split(text, "Sample:\n")[1], "\n")).cast("bigint").alias("n_sample"))
