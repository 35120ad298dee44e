"""Rule sets as rows: parse model text, validate, combine, count, gate, render."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.functions.rules import CROSS_COLUMN, PARSE_ERROR
from rulemill.functions.text import squeeze_code, strip_fence

# Parsed documents that a task keeps, and the length up to which one is kept.
KEPT_DOCUMENTS, KEPT_LENGTH = 4096, 4096


def parse_responses(df: DataFrame, raw_col: str) -> DataFrame:
    """Model text to rule rows; never fails on odd text.

    Adds ``pos, column, rule, source, note, is_object``. A single object counts
    as a one-element list, other text becomes one ``_parse_error`` row holding
    it, a missing source becomes ``llm`` and an empty list gives no rows.
    """
    cleaned = df.withColumn("_text", strip_fence(F.col(raw_col))).withColumn("_v", F.try_parse_json("_text"))
    kind = F.coalesce(F.schema_of_variant("_v"), F.lit(""))
    nothing = F.lit(None).cast("variant")
    items = (F.when(kind.startswith("ARRAY"), F.transform(
                F.try_variant_get("_v", "$", "array<variant>"), lambda v: F.struct(v.alias("v"), F.lit(False).alias("bad"))))
             .when(kind.startswith("OBJECT"), F.array(F.struct(F.col("_v").alias("v"), F.lit(False).alias("bad"))))
             .otherwise(F.array(F.struct(nothing.alias("v"), F.lit(True).alias("bad")))))
    each = cleaned.select(*df.columns, "_text", F.posexplode(items).alias("pos", "_item"))
    bad = F.col("_item.bad")

    def field(name):
        return F.try_variant_get(F.col("_item.v"), f"$.{name}", "string")

    is_object = F.coalesce(F.schema_of_variant(F.col("_item.v")).startswith("OBJECT"), F.lit(False))
    return each.select(
        *df.columns, "pos", F.when(bad, PARSE_ERROR).otherwise(field("column")).alias("column"),
        F.when(bad, F.col("_text")).otherwise(field("rule")).alias("rule"),
        F.when(bad, F.lit("llm")).when(is_object, F.coalesce(field("source"), F.lit("llm"))).alias("source"),
        F.when(~bad, field("note")).alias("note"), (bad | is_object).alias("is_object"))


def judge_rules(rules: DataFrame) -> DataFrame:
    """Adds ``reason``: null for a rule that is an object with a column and a rule."""
    return rules.withColumn("reason", F.when(~F.col("is_object"), "not an object")
                            .when(F.col("column").isNull(), "missing column")
                            .when(F.col("rule").isNull(), "missing rule"))


def validate_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``reason``). Both read the same input: where it is
    costly, take ``judge_rules`` or write the rules first."""
    checked = judge_rules(rules)
    return (checked.where(F.col("reason").isNull()).drop("reason"),
            checked.where(F.col("reason").isNotNull()))


def combine(first: DataFrame, second: DataFrame) -> DataFrame:
    """Schema rules then advanced rules; a bag union."""
    return first.unionByName(second, allowMissingColumns=True)


def novel_rules(new: DataFrame, known: DataFrame) -> DataFrame:
    """Rules of ``new`` whose text no known rule has, one row per normalised text, in
    which quoted text keeps its case. ``coverage.coverage`` compares what rules find instead.

    Both sides shrink to distinct keys before they meet.
    """
    def keyed(df):
        return df.select(F.lower("column").alias("column_key"), squeeze_code(F.col("rule")).alias("rule_key"), "rule")

    fresh = (keyed(new).groupBy("column_key", "rule_key")
             .agg(F.min("rule").alias("rule"), F.count(F.lit(1)).alias("n_proposals")))
    seen = keyed(known).select("column_key", "rule_key").distinct()
    return fresh.join(seen, ["column_key", "rule_key"], "left_anti")


def rules_json(rules: DataFrame, by: str = "table_name") -> DataFrame:
    """One JSON rule array per table, sorted. Duplicates of a rule collapse
    first, so a list is as long as the table's rule set, not its input."""
    cols = [F.col(c) for c in ("column", "rule", "source") if c in rules.columns]
    distinct = rules.select(by, F.struct(*cols).alias("r")).distinct()
    return distinct.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.to_json(F.array_sort(F.collect_list("r"))).alias("rules_json"))


def read_documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, groups, error) of nested YAML rule documents; one of the two is null.

    Parsing costs far more than its bytes show, so rows are dealt out by their content first, and a short
    text that comes again in a task is parsed once.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    groups = "array<struct<column:string,rules:array<string>>>"

    def load_documents(batches):
        import yaml

        def read(text):
            try:
                doc = yaml.safe_load(text)
                return [{"column": str(g["column"]), "rules": [str(r) for r in g["rules"]]} for g in doc["rules"]], None
            except Exception as e:  # a bad document must not stop the others
                return None, type(e).__name__

        kept = lru_cache(KEPT_DOCUMENTS)(read)
        for pdf in batches:
            found = [kept(t) if isinstance(t, str) and len(t) <= KEPT_LENGTH else read(t) for t in pdf[text_col]]
            yield pd.DataFrame({id_col: pdf[id_col], "groups": [g for g, _ in found], "error": [e for _, e in found]})

    rows = df.select(id_col, text_col).repartition(id_col, text_col)
    return rows.mapInPandas(load_documents, f"{id_col} {id_type}, groups {groups}, error string")


def flatten_documents(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Nested YAML rule documents to (rule rows, documents with an error). Each parses
    the documents; ``flatten_all`` gives both kinds of row from one pass."""
    docs = read_documents(df, id_col, text_col)
    rows = (docs.where(F.col("error").isNull())
            .select(id_col, F.posexplode("groups").alias("group_pos", "g"))
            .select(id_col, "group_pos", F.col("g.column").alias("column"),
                    F.posexplode("g.rules").alias("rule_pos", "rule")))
    return rows, docs.where(F.col("error").isNotNull()).select(id_col, "error")


def flatten_all(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, group_pos, column, rule_pos, rule): the rule rows, and for a document with an
    error one row at places -1, without a column, that has the error as its rule."""
    docs, bad = read_documents(df, id_col, text_col), F.col("error").isNotNull()
    groups = F.when(bad, F.array(F.struct(F.lit(None).cast("string").alias("column"), F.array("error").alias("rules")))).otherwise(F.col("groups"))
    each = docs.select(id_col, "error", F.posexplode(groups).alias("group_pos", "g"))
    each = each.select(id_col, "error", "group_pos", F.col("g.column").alias("column"), F.posexplode("g.rules").alias("rule_pos", "rule"))
    place = lambda c: F.when(bad, F.lit(-1)).otherwise(F.col(c)).alias(c)
    return each.select(id_col, place("group_pos"), "column", place("rule_pos"), "rule")


def rule_metrics(rules: DataFrame, by: str) -> DataFrame:
    """Rule counts per run: total, by source, cross-column, and column groups."""
    return rules.groupBy(by).agg(
        F.count(F.lit(1)).alias("rules_generated"),
        F.count_if(F.col("source") == "schema").alias("schema_rules"),
        F.count_if(F.col("source") == "llm").alias("llm_rules"),
        F.count_if(F.col("column") == CROSS_COLUMN).alias("cross_column_rules"),
        F.count_distinct("column").alias("column_groups"))


def gate(rules: DataFrame, by: str, min_rules: int) -> DataFrame:
    """Per table: enough usable rules and no parse errors. Counts rules, not
    output rows, and leaves parse errors out."""
    error = F.col("column") == PARSE_ERROR
    return (rules.groupBy(by).agg(F.count_if(~error).alias("n_rules"), F.count_if(error).alias("n_errors"))
            .withColumn("passed", (F.col("n_rules") >= min_rules) & (F.col("n_errors") == 0)))


def render_rules(rules: DataFrame, table_name: str, order_by: list[str], n: int | None = None) -> DataFrame:
    """Listing line and check SQL per rule, the first ``n`` in order."""
    shown = rules.select(
        *order_by,
        F.concat(F.rpad(F.concat(F.lit("["), "source", F.lit("]")), 10, " "), F.rpad("column", 20, " "),
                 F.lit(" -> "), "rule").alias("line"),
        F.concat(F.lit(f"SELECT COUNT(*) FROM {table_name} WHERE NOT ("), "rule", F.lit(")")).alias("check_sql"))
    return shown if n is None else shown.orderBy(*order_by).limit(n)
