"""Rule evaluation: counts, row tags, quarantine split, scorecards, recall.

Rules are evaluated many per scan. Each batch turns a row into an array of rule
results, explodes it and counts by rule number, so partial counts are made
before the shuffle and at most (rules x tasks) small rows move. Batches are
limited by rule count and by text size because one generated method that grows
too large is no longer compiled by the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.functions.rules import CROSS_COLUMN, RULE_SCHEMA, Rule, predicate

BATCH_RULES = 50
BATCH_CHARS = 2400


def batches(rules: list[Rule], max_rules: int = BATCH_RULES,
            max_chars: int = BATCH_CHARS) -> list[list[Rule]]:
    """Split rules by count and by total predicate text."""
    out: list[list[Rule]] = []
    size = 0
    for r in rules:
        if not out or len(out[-1]) >= max_rules or size + len(r.rule) > max_chars:
            out.append([])
            size = 0
        out[-1].append(r)
        size += len(r.rule)
    return out


def _counts(df: DataFrame, rules: list[Rule], keys: list[str], max_rules: int) -> DataFrame:
    parts = []
    start = 0
    for batch in batches(rules, max_rules):
        results = F.array(*[predicate(r).cast("boolean") for r in batch])
        parts.append(
            df.select(*keys, F.posexplode(results).alias("_i", "_ok"))
            .groupBy(*keys, "_i")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("_ok")).alias("passed"),
                 F.count_if(~F.col("_ok")).alias("failed"))
            .withColumn("_i", F.col("_i") + start))
        start += len(batch)
    if not parts:  # no rule: no counts, in the same shape
        return df.select(*keys, *(F.lit(0).cast(t).alias(c) for c, t in (("_i", "int"), ("n_rows", "bigint"), ("passed", "bigint"), ("failed", "bigint")))).limit(0)
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return counts


def _numbered(df: DataFrame, rules: list[Rule]) -> DataFrame:
    spark = df.sparkSession
    rows = [(i, *r.row()) for i, r in enumerate(rules)]
    schema = "_i int, " + ", ".join(f"`{f.name}` string" for f in RULE_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


def evaluate(df: DataFrame, rules: list[Rule], max_rules: int = BATCH_RULES) -> DataFrame:
    """Rows (rule_id, column, rule, source, n_rows, passed, failed, unknown, pass_rate).

    A NULL result is neither a pass nor a failure. Every rule has a row, also
    over an empty table.
    """
    counts = _counts(df, rules, [], max_rules)
    zero = F.lit(0).cast("bigint")
    n, ok, bad = (F.coalesce(c, zero) for c in ("n_rows", "passed", "failed"))
    return (_numbered(df, rules).join(counts, "_i", "left")
            .select("rule_id", "column", "rule", "source",
                    n.alias("n_rows"), ok.alias("passed"), bad.alias("failed"),
                    (n - ok - bad).alias("unknown"),
                    F.round(F.try_divide(ok, n), 6).alias("pass_rate")))


def evaluate_by(df: DataFrame, rules: list[Rule], keys: list[str], totals: bool = False,
                max_rules: int = BATCH_RULES) -> DataFrame:
    """The same counts per group; ``totals`` adds an ``ALL`` row per rule, and a column ``level``, 0 for groups and 1
    for totals, which tells them from a group whose key reads ``ALL``."""
    counts = _counts(df, rules, keys, max_rules)
    for k in keys:
        counts = counts.withColumn(k, F.col(k).cast("string"))
    if totals:
        total = counts.groupBy("_i").agg(*[F.sum(c).alias(c) for c in ("n_rows", "passed", "failed")])
        for k in keys:
            total = total.withColumn(k, F.lit("ALL"))
        counts = counts.withColumn("level", F.lit(0)).unionByName(total.withColumn("level", F.lit(1)))
    return (counts.join(F.broadcast(_numbered(df, rules)), "_i")
            .select("rule_id", *keys, *(["level"] if totals else []), "n_rows", "passed", "failed",
                    (F.col("n_rows") - F.col("passed") - F.col("failed")).alias("unknown"),
                    F.round(F.col("failed") / F.col("n_rows"), 6).alias("violation_rate")))


def tag(df: DataFrame, rules: list[Rule], max_rules: int = BATCH_RULES) -> DataFrame:
    """Add ``failed_rules``: comma-joined ids of the rules a row fails.

    ``concat_ws`` skips nulls and is generated code, unlike a lambda filter
    over an array. Use ``split(failed_rules, ',')`` where an array is wanted.
    The text is exploded from a one-element array because a later filter on it
    is then not pushed down, which would evaluate every rule twice per row.
    """
    chunks = [F.concat_ws(",", *[F.when(~predicate(r), r.rule_id) for r in b])
              for b in batches(rules, max_rules)] or [F.lit("")]
    text = chunks[0] if len(chunks) == 1 else F.concat_ws(",", *[F.nullif(c, F.lit("")) for c in chunks])
    return df.select("*", F.explode(F.array(text)).alias("failed_rules"))


def split(df: DataFrame, rules: list[Rule], severity: str = "error",
          max_rules: int = BATCH_RULES) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine with ``failed_rules``). Rules of another severity do
    not quarantine."""
    tagged = tag(df, [r for r in rules if r.severity == severity], max_rules)
    return (tagged.where(F.col("failed_rules") == "").drop("failed_rules"),
            tagged.where(F.col("failed_rules") != ""))


def write_split(df: DataFrame, rules: list[Rule], path: str, severity: str = "error",
                mode: str = "overwrite") -> str:
    """Write both sides in one pass over the input, as partitions
    ``outcome=clean`` and ``outcome=quarantine``."""
    tagged = tag(df, [r for r in rules if r.severity == severity])
    outcome = F.when(F.col("failed_rules") == "", "clean").otherwise("quarantine")
    tagged.withColumn("outcome", outcome).write.mode(mode).partitionBy("outcome").parquet(path)
    return path


def columns_named(rule: Rule, names: list[str]) -> list[str]:
    """Columns a rule covers: its own, or for a cross-column rule all it names."""
    if rule.column != CROSS_COLUMN:
        return [rule.column] if rule.column in names else []
    words = set(re.findall(r"\w+", re.sub(r"'(?:[^']|'')*'", " ", rule.rule)))
    return [n for n in names if n in words]


def scorecard(df: DataFrame, rules: list[Rule], table_name: str) -> DataFrame:
    """One row: rule coverage of the columns and the mean pass rate."""
    covered = {c for r in rules for c in columns_named(r, df.columns)}
    return evaluate(df, rules).agg(
        F.lit(table_name).alias("table_name"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(len(covered)).cast("bigint").alias("covered_columns"),
        F.lit(round(len(covered) / len(df.columns), 4)).alias("rule_coverage"),
        F.count(F.lit(1)).alias("n_rules"),
        F.sum("failed").alias("violations"),
        F.round(F.avg("pass_rate"), 4).alias("mean_pass_rate"))


def recall(injected: DataFrame, rules: list[Rule], caught_by: dict[str, str]) -> DataFrame:
    """Confusion counts of planted defects against the rules meant to catch
    them. ``caught_by`` maps a defect name to a rule id; its row count is the
    number of defect classes."""
    tagged = tag(injected, rules)
    pairs = F.array(*[
        F.struct(F.lit(d).alias("defect"), F.lit(r).alias("rule_id"),
                 F.array_contains(F.split("defects", ","), d).alias("planted"),
                 F.array_contains(F.split("failed_rules", ","), r).alias("caught"))
        for d, r in caught_by.items()])
    p, c = F.col("planted"), F.col("caught")
    return (tagged.select(F.inline(pairs)).groupBy("defect", "rule_id")
            .agg(F.count_if(p).alias("planted"),
                 F.count_if(p & c).alias("caught"),
                 F.count_if(p & ~c).alias("missed"),
                 F.count_if(~p & c).alias("unplanned"))
            .withColumn("recall", F.round(F.try_divide("caught", "planted"), 6)))
