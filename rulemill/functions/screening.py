"""Screening of untrusted rule text before it becomes an expression.

Spark's analyser accepts far more than a row check: aggregates, subqueries and
calls into the JVM all analyse as Boolean. So a rule may only be built from
known columns, literals, a short list of operators and a fixed list of
functions, read into a typed tree (``functions.expressions``); the analyser then confirms that it is
Boolean over an empty frame. Under ANSI rules a bad implicit cast, an overflow or a division by zero stops the
whole job, so operands of different families, plain division and plain casts are refused, and
arithmetic is accepted in its ``try_`` form: where it overflows, the rule is unknown.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.functions.expressions import CAST_TYPES, FUNCTIONS, KEYWORDS, Refused, parse, safe_text, tokens
from rulemill.functions.rules import CROSS_COLUMN, PARSE_ERROR, Rule, predicate


def _compiles(pattern: str) -> bool:
    """Does Java compile the pattern?"""
    from pyspark import SparkContext
    try:
        SparkContext._active_spark_context._jvm.java.util.regex.Pattern.compile(pattern)
    except Exception:
        return False
    return True


def _check_names(toks: list[tuple[str, str]], types: dict[str, T.DataType]) -> None:
    """Refuses names that are neither columns nor listed, wherever they stand."""
    for i, (kind, word) in enumerate(toks):
        low, nxt, prev = word.lower(), toks[i + 1][1] if i + 1 < len(toks) else "", toks[i - 1][1].lower() if i else ""
        if kind == "quoted" and low.strip("`") not in types:
            raise Refused(f"unknown column: {word.strip('`')}")
        if kind != "name" or low in KEYWORDS:
            continue
        if nxt == "(":
            if low not in FUNCTIONS:
                raise Refused(f"function not allowed: {low}")
        elif low not in types and not (low in CAST_TYPES and prev == "as"):
            raise Refused(f"unknown column: {word}")


def read_rule(text: str, types: dict[str, T.DataType]) -> str:
    """The text to run, or ``Refused``."""
    if "--" in text or "/*" in text or "\\'" in text:
        raise Refused("comment or escaped quote")
    _check_names(tokens(text), types)
    node = parse(text, types, _compiles)
    if node.family not in ("boolean", None):
        raise Refused("not Boolean")
    return safe_text(text, node)


def _analyser_reason(empty: DataFrame, rule: Rule) -> str | None:
    try:
        dtype = empty.select(predicate(rule).alias("r")).schema["r"].dataType
    except (AnalysisException, ParseException) as e:
        return f"does not analyse: {(e.getCondition() or 'PARSE').split('.')[0]}"
    except PySparkException:
        return "does not analyse"
    return None if isinstance(dtype, T.BooleanType) else "not Boolean"


def screen(spark: SparkSession, rules: list[Rule],
           schema: T.StructType) -> tuple[list[Rule], list[tuple[Rule, str]]]:
    """(accepted, rejected with reason). Only rule text and the schema are looked at. Accepted
    rules with arithmetic carry its ``try_`` form as their text."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    empty = spark.createDataFrame([], schema)
    accepted, rejected = [], []
    for rule in rules:
        if rule.column == PARSE_ERROR:
            reason = "parse error"
        elif not rule.rule or not rule.rule.strip():
            reason = "empty rule"
        elif rule.column != CROSS_COLUMN and rule.column.lower() not in types:
            reason = f"unknown column: {rule.column}"
        else:
            try:
                rule = replace(rule, rule=read_rule(rule.rule, types))
                reason = _analyser_reason(empty, rule)
            except Refused as e:
                reason = str(e)
        if reason:
            rejected.append((rule, reason))
        else:
            accepted.append(rule)
    return accepted, rejected


def screening_report(df: DataFrame, rules: list[Rule], evaluate) -> DataFrame:
    """Accepted rules with their counts over ``df`` beside the rejected ones."""
    spark = df.sparkSession
    accepted, rejected = screen(spark, rules, df.schema)
    bad = spark.createDataFrame(
        [(r.rule_id, "rejected", why) for r, why in rejected], "rule_id string, verdict string, reason string")
    zero = F.lit(0).cast("bigint")
    bad = bad.select("*", zero.alias("passed"), zero.alias("failed"), zero.alias("unknown"))
    if not accepted:
        return bad
    good = evaluate(df, accepted).select(
        "rule_id", F.lit("accepted").alias("verdict"), F.lit("").alias("reason"), "passed", "failed", "unknown")
    return good.unionByName(bad)
