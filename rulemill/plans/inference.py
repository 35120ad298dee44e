"""Queries for batch model calls with the offline clients."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import inference as inf
from rulemill.operators import rulesets as rs
from rulemill.plans.catalog import query
from rulemill.plans.prompts import _COLUMN_TYPES, _prompts
from rulemill.sources.tables import load


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS \"column\", '{c} IS NOT NULL' AS rule, 'llm' AS source"
    for t, cols in _COLUMN_TYPES.items() for c, _ in cols))
def infer_offline(spark, sf_dir):
    """Profile, prompt, model call written once, and parse."""
    answered = inf.infer_once(_prompts(spark, sf_dir), "prompt", inf.SchemaEchoClient)
    rules, _ = rs.validate_rules(rs.parse_responses(answered, "response"))
    return rules.select("table_name", "column", "rule", "source")


@query("""SELECT s_suppkey, c AS "column", n AS n_rules FROM supplier, (VALUES ('product_id', 2), ('quantity', 2),
          ('estimated_arrival_date', 3)) v(c, n)""")
def infer_documents(spark, sf_dir):
    """One prompt per supplier, answered with a nested rule document."""
    prompts = load(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat(F.lit("Propose rules for the manifest of "), "s_name").alias("prompt"))
    rows, _ = rs.flatten_documents(inf.infer(prompts, "prompt", inf.CannedClient), "s_suppkey", "response")
    return rows.groupBy("s_suppkey", "column").agg(F.count(F.lit(1)).alias("n_rules"))


@query("""SELECT s_suppkey, 'ValueError: prompt lists no columns' AS error FROM supplier""")
def infer_errors(spark, sf_dir):
    """A prompt the client cannot answer gives an error row, not a failed job."""
    prompts = load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("prompt"))
    return inf.infer(prompts, "prompt", inf.SchemaEchoClient).select("s_suppkey", "error")
