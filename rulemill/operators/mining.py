"""Rules from schemas and rules mined from the data itself."""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.functions.phrases import compile_phrase
from rulemill.functions.quantiles import exact_quantiles, melt_numeric
from rulemill.functions.rules import CROSS_COLUMN, Rule
from rulemill.functions.text import shape


def quoted(name: str) -> str:
    """A column name as rule text: in backticks unless it is a plain word."""
    return name if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name) else "`" + name.replace("`", "``") + "`"


def rules_not_null(schema: T.StructType, contract: list[str] | None = None) -> list[Rule]:
    """NOT NULL rules. Stored tables lose nullability, so the columns that must
    be present can be declared by ``contract``."""
    required = {f.name for f in schema.fields if not f.nullable} | set(contract or [])
    return [Rule(f"not_null_{f.name}", f.name, f"{quoted(f.name)} IS NOT NULL", "schema",
                 "Column is declared non-nullable")
            for f in schema.fields if f.name in required]


def rules_numeric(schema: T.StructType, form: str = "default") -> list[Rule]:
    """Non-negativity rules for numeric columns.

    ``form='reference'`` keeps the published predicate text, which is true for
    every value that is not null and so never reports a violation. The default
    form reports negative values.
    """
    text = {"reference": "{c} IS NOT NULL OR {c} >= 0", "default": "{c} IS NULL OR {c} >= 0"}[form]
    return [Rule(f"numeric_{f.name}", f.name, text.format(c=quoted(f.name)), "schema", "Numeric column")
            for f in schema.fields if isinstance(f.dataType, T.NumericType)]


def phrase_rules(groups: list[tuple[str, list[str]]], as_of: str) -> tuple[list[Rule], list[tuple[str, str]]]:
    """(rules, phrases not understood) from (column, phrases) groups."""
    rules, unknown = [], []
    for column, phrases in groups:
        for i, phrase in enumerate(phrases):
            sql = compile_phrase(column, phrase, as_of)
            if sql is None:
                unknown.append((column, phrase))
            else:
                rules.append(Rule(f"{column}_{i + 1}", column, sql, "phrase", phrase))
    return rules, unknown


def mine_outliers(df: DataFrame, cols: list[str], k: float = 1.5, method: str = "iqr") -> DataFrame:
    """Bounds per column (Tukey fence or z-score) and the values beyond them."""
    if method == "iqr":
        q = (exact_quantiles(df, cols, [0.25, 0.75]).groupBy("column_name").agg(
            F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
            F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3")))
        spread = (F.col("q3") - F.col("q1")) * k
        bounds = q.select("column_name", (F.col("q1") - spread).alias("lo"), (F.col("q3") + spread).alias("hi"))
    elif method == "zscore":
        wide = df.agg(*[e for c in cols for e in (
            F.avg(c).alias(f"{c}__m"), F.stddev_samp(c).alias(f"{c}__s"))])
        bounds = wide.select(F.inline(F.array(*[F.struct(
            F.lit(c).alias("column_name"),
            (F.col(f"{c}__m") - k * F.col(f"{c}__s")).alias("lo"),
            (F.col(f"{c}__m") + k * F.col(f"{c}__s")).alias("hi")) for c in cols])))
    else:
        raise ValueError(f"unknown method: {method}")
    # One bounds row per column: the broadcast is bounded by the schema.
    v = F.col("value")
    return (melt_numeric(df, cols).join(F.broadcast(bounds), "column_name")
            .groupBy("column_name")
            .agg(F.round(F.first("lo"), 4).alias("lo"), F.round(F.first("hi"), 4).alias("hi"),
                 F.count(F.lit(1)).alias("n_values"),
                 F.count_if(v < F.col("lo")).alias("n_below"),
                 F.count_if(v > F.col("hi")).alias("n_above")))


def outlier_rules(bounds: DataFrame) -> list[Rule]:
    """Rules from mined bounds (one row per column)."""
    return [Rule(f"range_{r['column_name']}", r["column_name"],
                 f"{quoted(r['column_name'])} BETWEEN {r['lo']!r} AND {r['hi']!r}", "mined", "Outlier bounds")
            for r in bounds.orderBy("column_name").collect()]


def same_type_pairs(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """Ordered column pairs of one comparable family."""
    def family(t):
        if isinstance(t, T.NumericType):
            return "number"
        if isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return "time"
        return None
    named = [(f.name, family(f.dataType)) for f in df.schema.fields if f.name not in exclude]
    return [(a, b) for (a, x), (b, y) in itertools.permutations(named, 2) if x and x == y]


def mine_order_pairs(df: DataFrame, pairs: list[tuple[str, str]], min_support: float) -> DataFrame:
    """Column pairs where ``a <= b`` holds for at least ``min_support`` of rows."""
    held = {(a, b): F.col(f"`{a}`") <= F.col(f"`{b}`") for a, b in pairs}
    wide = df.agg(*[e for i, h in enumerate(held.values()) for e in (
        F.count(h).alias(f"n{i}"), F.count_if(h).alias(f"h{i}"))])
    entries = F.array(*[F.struct(
        F.lit(a).alias("left_column"), F.lit(b).alias("right_column"),
        F.lit(f"{quoted(a)} <= {quoted(b)}").alias("rule"), F.col(f"n{i}").alias("n_pairs"),
        F.round(F.try_divide(F.col(f"h{i}"), F.col(f"n{i}")), 6).alias("support"))
        for i, (a, b) in enumerate(held)])
    return (wide.select(F.inline(entries)).where(F.col("support") >= min_support)
            .withColumn("column", F.lit(CROSS_COLUMN)))


def mine_products(df: DataFrame, triples: list[tuple[str, str, str]], tol: float) -> DataFrame:
    """Support of ``abs(a * b - c) <= tol`` for each (a, b, c)."""
    aggs, entries = [], []
    for i, (a, b, c) in enumerate(triples):
        ok = F.abs(F.col(f"`{a}`") * F.col(f"`{b}`") - F.col(f"`{c}`")) <= tol
        aggs += [F.count(ok).alias(f"n{i}"), F.count_if(ok).alias(f"h{i}")]
        entries.append(F.struct(
            F.lit(f"abs({quoted(a)} * {quoted(b)} - {quoted(c)}) <= {tol}").alias("rule"), F.col(f"n{i}").alias("n_rows"),
            F.round(F.try_divide(F.col(f"h{i}"), F.col(f"n{i}")), 6).alias("support")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def mine_formats(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most common text shapes of a column, each with a regex."""
    # A constant number of shapes per column is not assumed: counts are
    # combined per task, and the top k is a distributed top-k.
    counts = (df.where(F.col(col).isNotNull()).groupBy(shape(F.col(col)).alias("shape"))
              .agg(F.count(F.lit(1)).alias("n")))
    escaped = F.regexp_replace("shape", r"([^A-Za-z0-9 ])", r"\\$1")
    regex = F.regexp_replace(F.regexp_replace(escaped, "A", "[A-Za-z]"), "9", "[0-9]")
    return (counts.orderBy(F.desc("n"), "shape").limit(k)
            .select(F.lit(col).alias("column_name"), "shape", "n",
                    F.concat(F.lit("^"), regex, F.lit("$")).alias("regex")))


_RUN = r"(A+|9+|[^A9])"


def mine_patterns(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most common patterns of a text column, runs of letters and of digits of any script with their lengths:
    (column_name, pattern, regex, n, coverage). ``A9-99`` and ``A9-999`` are one pattern with two to three digits.

    Texts shrink to their shapes in the task that reads them, shapes to patterns, and only the k patterns are
    looked at run by run. A text is counted by exactly one pattern and matches its regex. Empty texts are a pattern
    of their own; nulls do not count.
    """
    shapes = (df.where(F.col(col).isNotNull())
              .groupBy(F.regexp_replace(F.regexp_replace(F.col(col), r"\p{L}", "A"), r"\p{Nd}", "9").alias("shape")).agg(F.count(F.lit(1)).alias("n")))
    merged = shapes.withColumn("pattern", F.regexp_replace(F.regexp_replace("shape", "A+", "A"), "9+", "9"))
    total = shapes.agg(F.sum("n")).scalar()
    top = merged.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pattern").limit(k).withColumn("coverage", F.round(F.col("n") / total, 6))
    runs = merged.join(top.select("pattern"), "pattern", "left_semi").select("pattern", F.posexplode(F.regexp_extract_all("shape", F.lit(_RUN), F.lit(1))).alias("at", "run"))
    lengths = runs.groupBy("pattern", "at").agg(F.min(F.length("run")).alias("lo"), F.max(F.length("run")).alias("hi"), F.first(F.left("run", F.lit(1))).alias("kind"))
    count = F.when(F.col("hi") == 1, "").when(F.col("lo") == F.col("hi"), F.concat(F.lit("{"), F.col("lo").cast("string"), F.lit("}"))).otherwise(
        F.concat(F.lit("{"), F.col("lo").cast("string"), F.lit(","), F.col("hi").cast("string"), F.lit("}")))
    piece = F.when(F.col("kind") == "A", F.concat(F.lit(r"\p{L}"), count)).when(F.col("kind") == "9", F.concat(F.lit(r"\p{Nd}"), count)).when(
        F.col("kind").rlike(r"^[!-/:-@\[-`{-~]"), F.concat(F.lit("\\"), "kind")).otherwise(F.col("kind"))
    regex = lengths.groupBy("pattern").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", piece.alias("piece")))), lambda x: x["piece"]), "").alias("regex"))
    return top.join(regex, "pattern", "left").select(
        F.lit(col).alias("column_name"), "pattern", F.concat(F.lit("^"), F.coalesce("regex", F.lit("")), F.lit(r"\z")).alias("regex"), "n", "coverage")


def mine_enums(df: DataFrame, cols: list[str], max_card: int) -> DataFrame:
    """``IN`` rules for the columns with at most ``max_card`` values.

    A sketch drops the wide columns first, so only columns known to be narrow
    are grouped by value and their value lists gathered.
    """
    sketch = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in cols]).first()
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    narrow = [c for c in cols if sketch[c] <= 2 * max_card]
    if not narrow:
        return df.sparkSession.createDataFrame(
            [], "column_name string, n_values bigint, n_rows bigint, rule string")
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
                      for c in narrow])
    counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    text = F.concat(F.lit("'"), F.replace("value", F.lit("'"), F.lit("''")), F.lit("'"))
    literal = F.when(F.col("column_name").isin(numbers), F.col("value")).otherwise(text)
    names = F.element_at(F.create_map(*[F.lit(x) for c in narrow for x in (c, quoted(c))]), F.col("column_name"))
    return (counts.groupBy("column_name")
            .agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_rows"),
                 F.array_sort(F.collect_list(literal)).alias("values"))
            .where(F.col("n_values") <= max_card)
            .select("column_name", "n_values", "n_rows",
                    F.concat(names, F.lit(" IN ("), F.array_join("values", ", "), F.lit(")"))
                    .alias("rule")))


def mine_ranges(df: DataFrame, cols: list[str], q: float = 0.0) -> DataFrame:
    """Two-sided bounds per column: min/max, or the ``q`` and ``1 - q`` quantiles."""
    if q == 0.0:
        wide = df.agg(*[e for c in cols for e in (
            F.min(c).cast("double").alias(f"{c}__lo"), F.max(c).cast("double").alias(f"{c}__hi"))])
        return wide.select(F.inline(F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.col(f"{c}__lo").alias("lo"), F.col(f"{c}__hi").alias("hi"))
            for c in cols])))
    return (exact_quantiles(df, cols, [q, 1.0 - q]).groupBy("column_name").agg(
        F.round(F.min("value"), 4).alias("lo"), F.round(F.max("value"), 4).alias("hi")))


@dataclass(frozen=True)
class ReferenceCheck:
    counts: DataFrame
    orphans: DataFrame


def check_reference(df: DataFrame, col: str, ref: DataFrame, ref_col: str) -> ReferenceCheck:
    """Values that must exist in a reference table; NULL is unknown.

    Counts join one row per distinct value, so a value that fills a third of
    the table meets the reference once. The orphan rows are an anti join,
    broadcast by Spark only when the reference is small enough.
    """
    known = ref.select(F.col(ref_col).alias(col)).where(F.col(col).isNotNull()).distinct()
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    joined = per_value.join(known.withColumn("_known", F.lit(True)), col, "left")
    hit = F.col("_known").isNotNull()
    null = F.col(col).isNull()
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0).cast("bigint"))
    counts = joined.agg(
        F.lit(col).alias("column_name"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_rows"),
        total(hit).alias("matched"),
        total(~hit & ~null).alias("orphans"),
        total(null).alias("unknown"),
        F.count_if(~hit & ~null).alias("orphan_values"))
    orphans = df.where(F.col(col).isNotNull()).join(known, col, "left_anti")
    return ReferenceCheck(counts, orphans)


@dataclass(frozen=True)
class UniqueCheck:
    counts: DataFrame
    duplicates: DataFrame


def check_unique(df: DataFrame, cols: list[str]) -> UniqueCheck:
    """Key uniqueness: totals, and the keys that repeat."""
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.lit(",".join(cols)).alias("key_columns"),
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0).cast("bigint")).alias("extra_rows"))
    return UniqueCheck(counts, per_key.where(F.col("n") > 1))
