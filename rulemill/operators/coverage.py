"""Which proposed rules find nothing that known rules do not find already."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.functions.expressions import Refused, family_of, parse
from rulemill.functions.regions import encode, violations
from rulemill.functions.text import squeeze_code

_END = "struct<rank:int,number:double,text:string,side:int>"
_SIDE = f"box int, sides int, box_key string, col string, kind string, lo {_END}, hi {_END}"


def _possible(box: dict, kinds: dict[str, str]) -> dict | None:
    """The box without values that its columns' types rule out; None if a side is left empty."""
    out = {c: {k: spans for k, spans in region.items() if k == "null" or kinds.get(c, k) == k} for c, region in box.items()}
    return out if all(out.values()) else None


def _boxes(rule: str, kinds: dict[str, str]) -> list[dict]:
    try:
        found = [b for b in (_possible(b, kinds) for b in violations(parse(rule))) if b is not None]
    except Refused:  # not read: comparable with the same text alone
        found = [{f"text: {rule}": {"text": [((-1, 0, 0), (1, 0, 0))]}}]
    rows = [{"box": -1, "sides": 0}] if not found else []
    for k, box in enumerate(found):
        if not box:
            rows.append({"box": k, "sides": 0, "box_key": "every row"})
        for column, region in sorted(box.items()):
            for kind, spans in region.items():
                for lo, hi in spans:
                    rows.append({"box": k, "sides": len(box), "box_key": repr(sorted((c, sorted(r.items())) for c, r in box.items())),
                                 "col": column, "kind": kind, "lo": encode(lo), "hi": encode(hi)})
    return rows


def sides(rules: DataFrame, by: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The sides of the boxes in which each distinct rule is false; of (by..., rule_key, rule)."""
    families = {f.name.lower(): family_of(f.dataType) for f in schema.fields} if schema else {}
    known = {c: {"time": "text"}.get(f, f) for c, f in families.items() if f in ("number", "text", "time")}
    names = [n.split(" ")[0] for n in ("box int", "sides int", "box_key s", "col s", "kind s", "lo s", "hi s")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(*row, *(side.get(n) for n in names)) for row in pdf.itertuples(index=False, name=None) for side in _boxes(row[-1], known)]
            yield pd.DataFrame(out, columns=[*pdf.columns, *names])

    kinds = dict(rules.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*by, "rule_key", "rule"])
    return rules.select(*by, "rule_key", "rule").mapInPandas(run, f"{schema}, {_SIDE}")


def islands(spans: DataFrame, keys: list[str]) -> DataFrame:
    """The union of the intervals (keys, lo, hi) as disjoint ones that do not touch.

    Intervals with one end in common shrink to the longest before any is sorted, so one-sided bounds leave one row a key.
    """
    reduced = spans.groupBy(*keys, "lo").agg(F.max("hi").alias("hi")).groupBy(*keys, "hi").agg(F.min("lo").alias("lo"))
    w = W.partitionBy(*keys).orderBy("lo")
    before = F.max("hi").over(w.rowsBetween(W.unboundedPreceding, -1))
    starts = reduced.withColumn("_new", (before.isNull() | (F.col("lo") > before)).cast("int"))
    numbered = starts.withColumn("_island", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def _distinct(rules: DataFrame, by: list[str]) -> DataFrame:
    named = rules.where(F.col("rule").isNotNull()).withColumn("rule_key", squeeze_code(F.col("rule")))
    return named.groupBy(*by, "rule_key").agg(F.min("rule").alias("rule"), F.count(F.lit(1)).alias("n_proposals"))


def coverage(new: DataFrame, known: DataFrame, by: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """(by..., rule, n_proposals, verdict) of every distinct rule of ``new``: ``covered`` where each row that breaks it breaks a
    rule of ``known`` too, ``never fails`` where no row can break it, else ``novel``.

    ``x > 5`` covers ``x > 0``: what is not above 0 is not above 5. Several known rules may cover one rule
    together. ``by`` names columns, such as a table's name, within which rules are compared; nulls there are equal. A verdict
    ``covered`` is always right. ``novel`` may be too careful where a rule ties several columns with OR:
    such a box is covered by rules over one of its columns or by the same box. Rules that are not understood are covered by the same text.
    Rules in NULL are left out. ``schema``, where the rules' table is one, tells which columns hold numbers and which text; a column
    of unknown type could hold either.
    """
    by = by or []
    fresh = _distinct(new, by)
    new_sides, old = sides(fresh, by, schema), sides(_distinct(known, by), by, schema)
    keys = [*by, "col", "kind"]

    def same(a: str, b: str, cols: list[str]) -> Column:
        out = F.lit(True)
        for c in cols:
            out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
        return out

    known_islands = islands(old.where("sides = 1").select(*keys, "lo", "hi"), keys)
    own = [*by, "rule_key", "box", "sides", "box_key"]
    asked = new_sides.where("sides > 0").select(*own, "col", "kind", "lo", "hi", F.lit(1).alias("_new"), F.lit(None).cast(_END).alias("_end"))
    both = asked.unionByName(known_islands.select(*keys, "lo", F.lit(0).alias("_new"), F.col("hi").alias("_end")), allowMissingColumns=True)
    reach = F.last("_end", ignorenulls=True).over(W.partitionBy(*keys).orderBy("lo", "_new").rowsBetween(W.unboundedPreceding, 0))
    met = both.withColumn("_reach", reach).where("_new = 1").withColumn("_in", F.coalesce(F.col("_reach") >= F.col("hi"), F.lit(False)))
    by_side = met.groupBy(*own, "col").agg(F.min("_in").alias("_in"))
    by_box = by_side.groupBy(*own).agg(F.max("_in").alias("_in")).unionByName(
        new_sides.where("sides = 0").select(*own, (F.col("box") < 0).alias("_in")))
    again = old.where("sides <> 1 AND box >= 0").select(*by, "box_key").distinct().withColumn("_again", F.lit(True))
    by_box = by_box.alias("n").join(again.alias("k"), same("n", "k", [*by, "box_key"]), "left").select(
        *[F.col(f"n.{c}").alias(c) for c in [*by, "rule_key", "box"]], (F.col("_in") | F.coalesce("_again", F.lit(False))).alias("_in"))
    judged = by_box.groupBy(*by, "rule_key").agg(F.min("_in").alias("_in"), F.max("box").alias("_last"))
    verdict = F.when(F.col("_last") < 0, "never fails").when(F.col("_in"), "covered").otherwise("novel")
    return fresh.alias("f").join(judged.alias("j"), same("f", "j", [*by, "rule_key"])).select(
        *[F.col(f"f.{c}").alias(c) for c in by], "f.rule", "f.n_proposals", verdict.alias("verdict"))
