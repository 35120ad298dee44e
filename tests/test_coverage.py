import itertools
import random
from decimal import Decimal

import pytest

from rulemill.functions.expressions import parse
from rulemill.functions.regions import violations
from rulemill.functions.rules import CROSS_COLUMN, Rule
from rulemill.operators import evaluate as ev
from rulemill.operators.coverage import coverage
from rulemill.operators.mutation import kill_matrix, mutants, mutation_score
from tests.conftest import rows

GRID = [None, *(v / 2 for v in range(-2, 14)), 1e6, -1e6]


def truth(node, row):
    """Three-valued result over one row, written out anew."""
    op, args = node.op, node.args
    if op == "column":
        return row[node.value.lower()]
    if op == "number":
        return float(Decimal(node.value))
    if op == "truth":
        return node.value == "true"
    if op == "not":
        v = truth(args[0], row)
        return None if v is None else not v
    if op in ("and", "or"):
        a, b = truth(args[0], row), truth(args[1], row)
        decisive = op == "or"
        return decisive if decisive in (a, b) else None if None in (a, b) else not decisive
    if op == "isnull":
        return truth(args[0], row) is None
    if op == "between":
        return truth(parse("x >= y AND x <= z"), dict(zip("xyz", (truth(a, row) for a in args), strict=True)))
    values = [truth(a, row) for a in args]
    if op == "in":
        return None if values[0] is None else values[0] in values[1:]
    if None in values:
        return None
    a, b = values
    return {"=": a == b, "<>": a != b, "<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b}[node.value]


def condition(rng, columns, depth):
    if depth and rng.random() < 0.55:
        return f"({condition(rng, columns, depth - 1)} {rng.choice(['AND', 'OR'])} {condition(rng, columns, depth - 1)})"
    if depth and rng.random() < 0.2:
        return f"NOT {condition(rng, columns, depth - 1)}"
    c, v, w = rng.choice(columns), rng.randint(0, 5), rng.randint(0, 5)
    return rng.choice([f"{c} {rng.choice(['<', '<=', '>', '>=', '=', '<>'])} {v}", f"{v} {rng.choice(['<', '>='])} {c}", f"{c} BETWEEN {v} AND {w}", f"{c} IN ({v}, {w})",
                       f"{c} NOT IN ({v}, {w})", f"{c} IS NULL", f"{c} IS NOT NULL", f"{columns[0]} {rng.choice(['<', '<=', '=', '>'])} {columns[-1]}"])


def inside(boxes, row):
    def holds(column, region):
        if " ? " in column:
            a, b = (row[c] for c in column.split(" ? "))
            if a is None or b is None:
                return False
            value = Decimal((a > b) - (a < b))
        else:
            value = row.get(column)
            if value is None:
                return "null" in region
            value = Decimal(value)
        return any(lo <= (0, value, 0) and (0, value, 1) <= hi for lo, hi in region.get("number", []))
    return any(all(holds(c, r) for c, r in box.items()) for box in boxes)


def test_boxes_hold_exactly_the_rows_that_break_a_rule():
    rng = random.Random(4)
    for _ in range(400):
        text = condition(rng, ["a", "b"], 3)
        node = parse(text)
        boxes = violations(node)
        for a, b in itertools.product(rng.sample(GRID, 9), rng.sample(GRID, 9)):
            row = {"a": a, "b": b}
            if not any(c.startswith("(") for box in boxes for c in box):
                assert inside(boxes, row) == (truth(node, row) is False), (text, row)


def breaks(text, row):
    return truth(parse(text), row) is False


def test_verdicts_against_a_grid_of_values(spark):
    rng = random.Random(8)
    new, known = [], []
    for k in range(120):
        columns = ["a"] if k % 3 else ["a", "b"]
        new += [(k, condition(rng, columns, rng.randint(0, 2))) for _ in range(3)]
        known += [(k, condition(rng, columns, rng.randint(0, 2))) for _ in range(rng.randint(0, 3))]
    got = coverage(spark.createDataFrame(new, "t int, rule string"), spark.createDataFrame(known, "t int, rule string"), ["t"],
                   spark.createDataFrame([], "a double, B int").schema).collect()
    assert {r.verdict for r in got} == {"covered", "novel", "never fails"}
    for r in got:
        own = [t for k, t in known if k == r.t]
        two = r.t % 3 == 0
        grid = [{"a": a, "b": b} for a, b in itertools.product(GRID, GRID if two else [None])]
        bad = [row for row in grid if breaks(r.rule, row)]
        rest = [row for row in bad if not any(breaks(t, row) for t in own)]
        if r.verdict == "never fails":
            assert not bad, r
        elif r.verdict == "covered":
            assert bad and not rest, (r, own)
        elif not two:
            assert rest, (r, own)


@pytest.mark.parametrize(("known", "new", "verdict"), [
    (["x > 5"], "x > 0", "covered"), (["x > 0"], "x > 5", "novel"), (["X  >=  5"], "x >= 5", "covered"), (["x > 5"], "x >= 5", "covered"), (["x >= 5"], "x > 5", "novel"),
    (["s = 'A'"], "s = 'a'", "novel"), (["s IN ('a', 'b')"], "s IN ('a', 'b', 'c')", "covered"), (["x > 3", "x < 9"], "x BETWEEN 2 AND 10", "covered"),
    (["x > 3 OR y > 3"], "y > 3 OR x > 3", "covered"), (["y > 3"], "x > 3 OR y > 2", "covered"), (["a <= b"], "b >= a", "covered"), (["a < b"], "NOT (a > b)", "covered"), (["a <= b"], "a < b", "novel"),
    (["x IS NOT NULL"], "x IS NOT NULL AND x > 1", "novel"), (["x IS NOT NULL", "x > 1"], "x IS NOT NULL AND x > 1", "covered"), ([], "x = x OR true", "never fails"),
    (["length(s) > 3"], "LENGTH( s ) > 3", "covered"), (["length(s) > 3"], "length(s) > 2", "novel"), (["d >= '2024-01-02'"], "d >= DATE '2024-01-01'", "covered"), (["what ?"], "what ?", "covered")])
def test_verdicts(spark, known, new, verdict):
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts] + [(None,)], "rule string")
    assert [(r.rule, r.verdict) for r in coverage(frame([new, new]), frame(known)).collect()] == [(new, verdict)]


def test_null_scopes_and_empty_sides(spark):
    new = spark.createDataFrame([(None, "x > 1"), ("t", "x > 1")], "tab string, rule string")
    known = spark.createDataFrame([(None, "x > 1")], "tab string, rule string")
    assert rows(coverage(new, known, ["tab"]), "tab", "verdict") == sorted([(None, "covered"), ("t", "novel")], key=repr)
    assert coverage(new.limit(0), known, ["tab"]).count() == 0
    assert coverage(new, known.limit(0), ["tab"]).where("verdict = 'novel'").count() == 2


def test_mutants_differ_and_are_named_once():
    found = mutants(Rule("r", "x", "x IS NULL OR x BETWEEN 1 AND 5"))
    assert len({m.rule for m in found}) == len(found) == len({m.mutant_id for m in found})
    assert {m.change for m in found} == {"joined", "branch", "null branch", "negation", "bound", "unknown fails"}
    assert mutants(Rule("r", "x", "not a rule ?")) == []


def test_kill_matrix_counts_rows_that_differ(spark):
    df = spark.createDataFrame([(k, v) for k, v in enumerate([None, 0, 1, 3, 5, 6])], "id int, x int")
    rules = [Rule("a", "x", "x IS NULL OR x BETWEEN 1 AND 5"), Rule("b", "x", "x > 0"), Rule("c", CROSS_COLUMN, "id >= 0")]
    from pyspark.sql import functions as F
    got = kill_matrix(df, rules, F.lit("all"), max_rules=3)
    for r in got.collect():
        base = {q.rule_id: q.rule for q in rules}[r.rule_id]
        outcomes = df.selectExpr(f"{base} AS o", f"{r.mutant} AS m").collect()
        assert (r.n_rows, r.n_killing) == (6, sum(o.o != o.m for o in outcomes))
    score = {r.rule_id: r for r in mutation_score(got).collect()}
    assert score["b"].score == 1.0 and score["b"].survivors == "" and "unknown" not in score["b"].survivors
    assert 0 < score["c"].score < 1
    assert kill_matrix(df, [], F.lit("all")).count() == 0
    assert len(ev.batches(rules, 1)) == 3
