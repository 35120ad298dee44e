import datetime
import random
from decimal import Decimal

import pytest

from rulemill.functions.expressions import Refused, parse, to_text
from rulemill.functions.rules import CROSS_COLUMN, Rule
from rulemill.functions.screening import screen
from rulemill.operators import evaluate as ev

SCHEMA = "y tinyint, i int, l bigint, f double, m decimal(38,0), n decimal(10,2), s string, d date, t timestamp, z timestamp_ntz, b boolean, a array<int>, x binary"
DAY, TIME = datetime.date, datetime.datetime
EXTREMES = [
    (127, 2**31 - 1, 2**63 - 1, 1.7e308, Decimal("9" * 38), Decimal("99999999.99"), "a" * 20_000, DAY(9999, 12, 31), TIME(9999, 12, 31, 23), TIME(9999, 12, 31, 23), True, [1], b"x"),
    (-128, -2**31, -2**63, float("-inf"), Decimal("-" + "9" * 38), Decimal("-99999999.99"), "", DAY(1, 1, 1), TIME(1, 1, 2), TIME(1, 1, 2), False, [], b""),
    (0, 0, 0, float("nan"), Decimal(0), Decimal("0.00"), "12x", DAY(2024, 2, 29), TIME(2024, 2, 29), TIME(2024, 2, 29), None, None, None),
    tuple([None] * 13),
]
COLUMNS = "y i l f m n s d t z b a x".split()
LITERALS = ["0", "1", "-1", "2147483647", "9223372036854775807", "1e308", "0.1", "-2147483648", "123456789012345678901234567890", "'a'", "''", "'12'",
            "'2024-01-01'", "'2024-02-30'", "'9999-12-31 23:59:59'", "DATE '2024-01-01'", "DATE '2024-13-01'", "TIMESTAMP '2024-01-01 00:00:00'", "true", "NULL"]
CALLS = {"abs": 1, "coalesce": 2, "nullif": 2, "length": 1, "lower": 1, "trim": 1, "substring": 3, "left": 2, "startswith": 2, "concat": 2, "regexp_like": 2, "round": 2,
         "floor": 1, "ceil": 1, "greatest": 2, "least": 2, "isnull": 1, "isnan": 1, "year": 1, "month": 1, "datediff": 2, "date_add": 2, "try_add": 2, "try_divide": 2, "try_multiply": 2}


def value(rng, depth):
    pick = rng.random()
    if depth <= 0 or pick < 0.35:
        return rng.choice(COLUMNS) if rng.random() < 0.6 else rng.choice(LITERALS)
    if pick < 0.6:
        return f"({value(rng, depth - 1)} {rng.choice('+-*')} {value(rng, depth - 1)})"
    if pick < 0.65:
        return f"- {value(rng, depth - 1)}"
    if pick < 0.7:
        return f"try_cast({value(rng, depth - 1)} AS {rng.choice(['int', 'double', 'date', 'string', 'boolean', 'timestamp'])})"
    if pick < 0.78:
        return f"CASE WHEN {condition(rng, depth - 1)} THEN {value(rng, depth - 1)} ELSE {value(rng, depth - 1)} END"
    name = rng.choice(list(CALLS))
    return f"{name}({', '.join(value(rng, depth - 1) for _ in range(CALLS[name]))})"


def condition(rng, depth):
    pick = rng.random()
    if depth > 0 and pick < 0.3:
        return f"({condition(rng, depth - 1)} {rng.choice(['AND', 'OR'])} {condition(rng, depth - 1)})"
    if depth > 0 and pick < 0.4:
        return f"NOT {condition(rng, depth - 1)}"
    a = value(rng, depth)
    if pick < 0.5:
        return f"{a} IS {rng.choice(['', 'NOT '])}NULL"
    if pick < 0.58:
        return f"{a} BETWEEN {value(rng, depth - 1)} AND {value(rng, depth - 1)}"
    if pick < 0.66:
        return f"{a} IN ({value(rng, 0)}, {value(rng, 0)})"
    if pick < 0.72:
        return f"{a} {rng.choice(['LIKE', 'RLIKE'])} {rng.choice(['s', chr(39) + '(a|b)*c' + chr(39), chr(39) + 'a%' + chr(39), chr(39) + '^[a-z]+$' + chr(39), chr(39) + '[' + chr(39)])}"
    return f"{a} {rng.choice(['=', '<>', '<', '<=', '>', '>='])} {value(rng, depth)}"


@pytest.mark.parametrize("seed", [1, 2])
def test_no_accepted_rule_stops_a_job(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(EXTREMES, SCHEMA)
    rules = [Rule(f"r{k}", CROSS_COLUMN, condition(rng, rng.randint(0, 3))) for k in range(900)]
    good, bad = screen(spark, rules, df.schema)
    assert len(good) > 60 and len(bad) > 60
    counts = ev.evaluate(df, good).collect()
    assert len(counts) == len(good) and all(r.n_rows == len(EXTREMES) for r in counts)


@pytest.mark.parametrize(("text", "outcome"), [
    ("i + 1 > 0", [None, False, True, None]), ("l * 2 > 0", [None, None, False, None]), ("- i < 0", [True, None, False, None]), ("abs(l) >= 0", [True, None, True, None]),
    ("m + m > 0", [None, None, False, None]), ("i - 1 < 0", [False, None, True, None]), ("y * y > 0", [None, None, False, None])])
def test_overflow_is_unknown(spark, text, outcome):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(EXTREMES)], "k int, " + SCHEMA)
    good, bad = screen(spark, [Rule("r", CROSS_COLUMN, text)], df.schema)
    assert bad == []
    got = [r[0] for r in df.orderBy("k").selectExpr(good[0].rule).collect()]
    assert got == outcome


@pytest.mark.parametrize(("text", "why"), [
    ("CASE WHEN b THEN s ELSE 1 END = 'a'", "mixes number and text"), ("year(s) = 2024", "year of text"), ("d BETWEEN '2024-01-01' AND '2024-02-30'", "malformed date literal"),
    ("d IN ('x')", "malformed date literal"), ("s AND b", "text as a condition"), ("round(i, -1) > 0", "round by more"), ("s RLIKE '(a|b)*c'", "pattern repeats a group"),
    ("s LIKE 'a\\b'", "malformed pattern"), ("s LIKE s", "pattern is not a literal"), ("i > 1.00000000000000000000000000000000000001", "number too long"),
    ("a = a", "compares other with other"), ("date_add(d, i) > d", "date_add by more"), ("substring(s, 'a', 1) = 'b'", "substring of text literal"), ("i > 1 2", "does not analyse"),
    ("(" * 80 + "i > 1" + ")" * 80, "nested too deep")])
def test_what_can_fail_is_refused(spark, text, why):
    good, bad = screen(spark, [Rule("r", CROSS_COLUMN, text)], spark.createDataFrame([], SCHEMA).schema)
    assert good == [] and why in bad[0][1]


@pytest.mark.parametrize("text", [
    "a + b * c > 1 OR NOT d = 2 AND e < 3", "NOT a BETWEEN 1 AND 2 AND b IS NOT NULL", "a - b - c = - 1", "(x IN (1, 2)) = true", "CASE WHEN a > 1 THEN b ELSE c END <> 'it''s'",
    "NOT NOT a = 1", "a > 1 AND b > 2 OR c > 3 AND d > 4", "a LIKE 'x%' OR a NOT IN ('b', 'c')", "try_cast(a AS int) >= -5"])
def test_precedences_agree_with_spark(spark, text):
    """A tree written back with all its brackets analyses to the same plan."""
    df = spark.createDataFrame([], "a int, b int, c int, d int, e int, x int") if "LIKE" not in text and "CASE" not in text else spark.createDataFrame([], "a string, b string, c string")
    if "LIKE" not in text and "CASE" not in text:
        plan = lambda t: df.selectExpr(f"{t} AS r")._jdf.queryExecution().optimizedPlan().toString().split("#")[0]
        assert plan(text) == plan(to_text(parse(text)))
    assert to_text(parse(to_text(parse(text)))) == to_text(parse(text))


def test_reader_refuses_rubbish():
    for text in ("", "a >", "> 1", "a IN ()", "CASE END", "a BETWEEN 1", "f(1)", "a b", "(a", "IS NULL"):
        with pytest.raises(Refused):
            parse(text)
