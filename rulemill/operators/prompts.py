"""Prompt templates: validation, rendering, fingerprints, context assembly."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.functions.text import fingerprint

# The two placeholder styles, {{name}} and {name}.
PLACEHOLDER = {"double": r"\{\{\s*([A-Za-z_][A-Za-z0-9_]*)\s*\}\}", "single": r"\{([A-Za-z_][A-Za-z0-9_]*)\}"}
_MARK = "\u0001"


def variables(template: Column, style: str = "double") -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(template, F.lit(PLACEHOLDER[style]), F.lit(1))))


def validate_templates(df: DataFrame, template_col: str, required: list[str], style: str = "double") -> DataFrame:
    """Adds ``missing`` and ``extra`` variables (sorted, comma-joined) and ``valid``."""
    found = variables(F.col(template_col), style)
    wanted = F.array(*[F.lit(v) for v in sorted(required)])
    return (df.withColumn("missing", F.array_join(F.array_except(wanted, found), ","))
            .withColumn("extra", F.array_join(F.array_except(found, wanted), ","))
            .withColumn("valid", F.col("missing") == ""))


def render(df: DataFrame, template_col: str, values: dict[str, Column], style: str = "double") -> DataFrame:
    """Adds ``rendered`` and ``unresolved`` (variables with no value).

    Placeholders are marked first and filled second, so a value that itself
    looks like a placeholder is left alone.
    """
    text = F.regexp_replace(template_col, PLACEHOLDER[style], f"{_MARK}$1{_MARK}")
    for name, value in values.items():
        text = F.replace(text, F.lit(f"{_MARK}{name}{_MARK}"), value)
    shown = {"double": "{{$1}}", "single": "{$1}"}[style]
    text = F.regexp_replace(text, f"{_MARK}([A-Za-z0-9_]+){_MARK}", re.sub(r"([{}])", r"\\\1", shown))
    known = F.array(*[F.lit(v) for v in values])
    return (df.withColumn("rendered", text)
            .withColumn("unresolved", F.array_join(F.array_except(variables(F.col(template_col), style), known), ",")))


def with_fingerprint(df: DataFrame, col: str) -> DataFrame:
    """Adds the first 12 hex digits of SHA-256 and the length of a text."""
    return (df.withColumn("prompt_hash", fingerprint(F.col(col)))
            .withColumn("prompt_length", F.char_length(col).cast("bigint")))


def statistics_lines(profiles: DataFrame) -> DataFrame:
    """(table_name, rule): one line a column out of a profile, for ``build_prompts``."""
    shown = F.when(F.col("min_value").isNotNull(), F.concat(F.lit(", from "), "min_value", F.lit(" to "), "max_value")).otherwise("")
    count = lambda c: F.col(c).cast("string")
    return profiles.select("table_name", F.concat(F.col("column_name"), F.lit(": "), count("n_rows"), F.lit(" rows, "), count("n_nulls"), F.lit(" null, "),
                                                  F.coalesce(count("n_distinct"), F.lit("unknown")), F.lit(" distinct"), shown).alias("rule"))


def build_prompts(columns: DataFrame, rules: DataFrame, examples: str, retrieved: DataFrame | None = None,
                  statistics: DataFrame | None = None) -> DataFrame:
    """One prompt per table out of its columns, its basic rules, example rules
    and, if given, statistics and retrieved rules (each ``table_name, rule``).

    Lists are as long as a table has columns or distinct rules.
    """
    described = columns.groupBy("table_name").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("ordinal", "name", "type", "nullable"))),
        lambda c: F.concat(F.lit("- "), c["name"], F.lit(" ("), c["type"], F.lit(", nullable="),
                           c["nullable"].cast("string"), F.lit(")"))), "\n").alias("columns_text"))

    def listed(df, out):
        return df.select("table_name", "rule").distinct().groupBy("table_name").agg(
            F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), "rule"))), "\n").alias(out))

    joined = described.join(listed(rules, "rules_text"), "table_name", "left")
    parts = [F.concat(F.lit("Table: "), "table_name"), F.concat(F.lit("Columns:\n"), "columns_text")]
    if statistics is not None:
        joined = joined.join(listed(statistics, "statistics_text"), "table_name", "left")
        parts.append(F.concat(F.lit("Statistics:\n"), "statistics_text"))
    parts += [F.concat(F.lit("Known rules:\n"), F.coalesce("rules_text", F.lit("none"))), F.lit(f"Examples:\n{examples}")]
    if retrieved is not None:
        joined = joined.join(listed(retrieved, "retrieved_text"), "table_name", "left")
        parts.append(F.concat(F.lit("Rules of similar tables:\n"), "retrieved_text"))
    parts.append(F.lit("Propose further rules as a JSON array: outliers, business logic, "
                       "cross-column consistency, text formats, allowed values."))
    return joined.select("table_name", F.concat_ws("\n\n", *parts).alias("prompt"))
