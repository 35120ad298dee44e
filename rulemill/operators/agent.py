"""The two agent flows: from tables to rules, and from rules to checked counts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.functions.rules import PARSE_ERROR, Rule, rules_frame
from rulemill.functions.screening import screening_report
from rulemill.operators.documents import route_rules
from rulemill.operators.evaluate import evaluate
from rulemill.operators.inference import RuleClient, infer_once
from rulemill.operators.mining import phrase_rules, rules_not_null, rules_numeric
from rulemill.operators.profile import describe_schema, sample_rows, summary
from rulemill.operators.prompts import build_prompts
from rulemill.operators.rulesets import combine, flatten_documents, judge_rules, parse_responses
from rulemill.session import checkpointed


def propose(tables: dict[str, DataFrame], client_factory: Callable[[], RuleClient], examples: str,
            contracts: dict[str, list[str]] | None = None) -> DataFrame:
    """Rules for many tables at once: (table_name, rule_id, column, rule, source).

    Schema rules come from the column types; the model is asked for more with
    one prompt per table; its answers are parsed and structurally checked.
    """
    contracts = contracts or {}
    columns = reduce(DataFrame.unionByName, [describe_schema(df, t) for t, df in tables.items()])
    basic = reduce(DataFrame.unionByName, [
        rules_frame(df.sparkSession, rules_not_null(df.schema, contracts.get(t)) + rules_numeric(df.schema))
        .select(F.lit(t).alias("table_name"), "rule_id", "column", "rule", "source")
        for t, df in tables.items()])
    judged = answers(build_prompts(columns, basic, examples), client_factory)
    numbered = judged.where("reason IS NULL").select(
        "table_name", F.concat(F.col("source"), F.lit("_"), F.col("pos").cast("string")).alias("rule_id"), "column", "rule", "source")
    return combine(basic, numbered)


def answers(prompts: DataFrame, client_factory: Callable[[], RuleClient], **options) -> DataFrame:
    """The model's rules of each prompt, asked once, with ``reason``: null for a usable
    rule, else why it was rejected; a failed prompt is one row with its error."""
    answered = infer_once(prompts, "prompt", client_factory, **options)
    text = F.when(F.col("error").isNotNull(), F.to_json(F.array(F.struct(F.lit(PARSE_ERROR).alias("column"), F.col("error").alias("rule"))))).otherwise(F.col("response"))
    judged = judge_rules(parse_responses(answered.withColumn("response", text), "response"))
    return judged.withColumn("reason", F.when(F.col("error").isNotNull(), "failed prompt").otherwise(F.col("reason")))


def check(tables: dict[str, DataFrame], rules: DataFrame) -> DataFrame:
    """Screen and evaluate proposed rules, table by table, as one plan.

    Only rule rows come to the driver, to be compiled; each table is read in
    shared scans.
    """
    by_table: dict[str, list[Rule]] = {t: [] for t in tables}
    for r in rules.orderBy("table_name", "rule_id").collect():
        by_table[r["table_name"]].append(Rule(r["rule_id"], r["column"], r["rule"], r["source"]))
    return reduce(DataFrame.unionByName, [
        screening_report(df, by_table[t], evaluate).withColumn("table_name", F.lit(t))
        for t, df in tables.items() if by_table[t]])


def describe_for_prompt(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """One row of prompt text: schema, summary statistics and ``n`` sample rows.
    Each part is bounded by the number of columns or by ``n``."""
    shown = summary(df)
    stats = shown.select(F.lit("summary").alias("part"), F.to_json(F.struct(*shown.columns)).alias("line"))
    sample = sample_rows(df, n, key).select(F.lit("sample").alias("part"), F.col("row_json").alias("line"))
    joined = stats.unionByName(sample).agg(*[
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("part") == p, F.col("line")))), "\n").alias(p)
        for p in ("summary", "sample")])
    schema = ", ".join(f"{c}: {t}" for c, t in df.dtypes)
    return joined.select(F.concat_ws("\n\n", F.lit(f"Schema: {schema}"), F.concat(F.lit("Statistics:\n"), "summary"),
                                     F.concat(F.lit("Sample:\n"), "sample")).alias("context"))


def propose_phrases(df: DataFrame, key: list[str], client_factory: Callable[[], RuleClient], as_of: str,
                    prompt_id: int = 0) -> tuple[list[Rule], list[tuple[str, str]]]:
    """Rules for one DataFrame from a nested rule document of phrases.

    Historical rules are routed by keyword from the description and added to
    the prompt. Returns compiled rules and the phrases that were not understood.
    The description is written once, as it is read for both.
    """
    context = checkpointed(describe_for_prompt(df, key).withColumn("prompt_id", F.lit(prompt_id)), "context")
    history = route_rules(context, "context").groupBy("prompt_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rule_no", "rule"))), lambda r: r["rule"]), "\n")
        .alias("history"))
    prompts = context.join(history, "prompt_id").select("prompt_id", F.concat_ws(
        "\n\n", "context", F.concat(F.lit("Rules of similar data:\n"), "history"),
        F.lit("Propose data quality rules as YAML, grouped by column.")).alias("prompt"))
    rows, _ = flatten_documents(infer_once(prompts, "prompt", client_factory), "prompt_id", "response")
    groups: dict[str, list[str]] = {}
    for r in rows.orderBy("group_pos", "rule_pos").collect():
        groups.setdefault(r["column"], []).append(r["rule"])
    return phrase_rules(list(groups.items()), as_of)
