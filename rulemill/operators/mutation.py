"""How sharp a rule set is: change each rule a little and see whether the data notices."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.functions.expressions import Node, Refused, parse, to_text
from rulemill.functions.rules import Rule, predicate
from rulemill.operators.evaluate import batches

_LOOSER = {"<": "<=", "<=": "<", ">": ">=", ">=": ">", "=": "<>", "<>": "="}
_TURNED = {"<": ">", "<=": ">=", ">": "<", ">=": "<="}


@dataclass(frozen=True)
class Mutant:
    rule_id: str
    mutant_id: str
    change: str
    rule: str


def _changed(node: Node) -> Iterator[tuple[str, Node]]:
    """This node alone, changed in one way each time."""
    args = node.args
    if node.op == "compare":
        yield "edge", replace(node, value=_LOOSER[node.value])
        if node.value in _TURNED:
            yield "turned", replace(node, value=_TURNED[node.value])
    elif node.op in ("and", "or"):
        yield "joined", replace(node, op="or" if node.op == "and" else "and")
        null = [a.op == "isnull" or a.op == "not" and a.args[0].op == "isnull" for a in args]
        for k in (0, 1):
            yield "null branch" if null[1 - k] else "branch", args[k]
    elif node.op == "not":
        yield "negation", args[0]
    elif node.op == "isnull":
        yield "negation", Node("not", (node,))
    elif node.op == "between":
        yield "bound", Node("compare", args[:2], ">=")
        yield "bound", Node("compare", (args[0], args[2]), "<=")
    elif node.op == "in" and len(args) > 2:
        for k in range(1, len(args)):
            yield "item", replace(node, args=args[:k] + args[k + 1:])
    elif node.op == "number" and "e" not in node.value.lower():
        for step in (1, -1):
            yield "bound", replace(node, value=str(Decimal(node.value) + step))


def _anywhere(node: Node) -> Iterator[tuple[str, Node]]:
    yield from _changed(node)
    for k, arg in enumerate(node.args):
        for change, other in _anywhere(arg):
            yield change, replace(node, args=node.args[:k] + (other,) + node.args[k + 1:])


def mutants(rule: Rule) -> list[Mutant]:
    """The rule with one comparison, bound, connective, negation, list item or null branch changed, and with
    NULL made a failure. A rule that is not understood gives none; equal texts come once."""
    try:
        tree = parse(rule.rule)
    except Refused:
        return []
    found = {to_text(tree): ""}
    for change, other in _anywhere(tree):
        found.setdefault(to_text(other), change)
    found[f"coalesce({to_text(tree)}, false)"] = "unknown fails"
    return [Mutant(rule.rule_id, f"{rule.rule_id}~{k:02d}", change, text) for k, (text, change) in enumerate(found.items()) if change]


def kill_matrix(df: DataFrame, rules: list[Rule], label: Column, max_rules: int = 50) -> DataFrame:
    """(rule_id, mutant_id, change, mutant, label, n_rows, n_killing): for each mutant and value of ``label``, the rows
    and those on which it differs from its rule, NULL counting as an outcome of its own.

    All mutants of a batch share one scan: a row becomes an array of differences, which is counted by place before the
    shuffle, so a task sends at most mutants x labels rows. Every pair is listed that has a row.
    """
    by_id = {r.rule_id: r for r in rules}
    made = [m for r in rules for m in mutants(r)]
    spark = df.sparkSession
    listed = spark.createDataFrame([(i, m.rule_id, m.mutant_id, m.change, m.rule) for i, m in enumerate(made)],
                                   "_i int, rule_id string, mutant_id string, change string, mutant string")
    counts, start = None, 0
    for batch in batches([Rule(m.mutant_id, m.rule_id, f"{m.rule} {by_id[m.rule_id].rule}") for m in made], max_rules):
        own = made[start:start + len(batch)]
        differs = F.array(*[~predicate(by_id[m.rule_id]).cast("boolean").eqNullSafe(predicate(Rule(m.mutant_id, "", m.rule)).cast("boolean")) for m in own])
        part = (df.select(label.alias("label"), F.posexplode(differs).alias("_i", "_differs")).groupBy("label", "_i")
                .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("_differs").alias("n_killing")).withColumn("_i", F.col("_i") + start))
        counts = part if counts is None else counts.unionByName(part)
        start += len(batch)
    if counts is None:
        counts = df.select(label.alias("label"), *(F.lit(0).cast(t).alias(c) for c, t in (("_i", "int"), ("n_rows", "bigint"), ("n_killing", "bigint")))).limit(0)
    return counts.join(F.broadcast(listed), "_i").drop("_i").select("rule_id", "mutant_id", "change", "mutant", "label", "n_rows", "n_killing")


def mutation_score(matrix: DataFrame) -> DataFrame:
    """Per rule: its mutants, how many some row tells from the rule, the share, and the ids of those that survive."""
    each = matrix.groupBy("rule_id", "mutant_id").agg(F.sum("n_killing").alias("n"))
    return each.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n_mutants"), F.count_if(F.col("n") > 0).alias("n_killed"), F.round(F.avg((F.col("n") > 0).cast("int")), 6).alias("score"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.col("mutant_id")))), ",").alias("survivors"))
