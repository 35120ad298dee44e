import pytest
from pyspark.sql import functions as F

from rulemill.functions.phrases import compile_phrase
from rulemill.functions.rules import CROSS_COLUMN, Rule, raw_literals, rules_frame, rules_from
from rulemill.functions.screening import screen
from rulemill.operators import evaluate as ev
from rulemill.operators.mining import check_reference, check_unique, phrase_rules, rules_not_null, rules_numeric
from rulemill.plans.evaluation import line_rules
from rulemill.plans.sales_sql import SALES_RULES
from rulemill.session import shared_dir
from rulemill.sources.manifest import manifest_df
from rulemill.sources.sales import SALES_DEFECTS, SALES_KEYS, SALES_SCHEMA, inject, sales_view
from rulemill.sources.tables import load
from rulemill.streaming.validate import read_stream, validate_stream
from tests.conftest import rows

# The annotated delivery manifest.
MANIFEST = [
    ("CW-P-001", 10000, "2026-03-15T14:00:00Z", "SUP-001", True),
    ("CW-P-002", 5000, "2026-03-16", "SUP-001", True),
    ("CW-T-001", 250, "2026-03-17T18:30:00Z", "SUP-002", True),
    ("CW-P-001", 12000, "2025-01-10T10:00:00Z", "SUP-001", False),
    ("CW-X-999", 500, "2026-03-18T09:00:00Z", "SUP-003", False),
    ("CW-P-002", 0, "2026-03-19T11:00:00Z", "SUP-001", True),
    ("CW-T-001", None, "2026-03-20T12:00:00Z", "SUP-002", False),
    ("CW-P-001", 8000, "2026/03/21", "SUP-001", True),
    ("CW-P-003", 20000, "2026-03-22T16:00:00Z", "SUP-004", False),
    (None, 1500, "2026-03-23T13:00:00Z", "SUP-003", False),
]


def test_manifest_golden(spark):
    rules, unknown = phrase_rules([
        ("product_id", ["is not null", "starts with CW-", r"matches ^CW-[PT]-\d{3}$"]),
        ("quantity", ["is not null", "must be > 0"]),
        ("estimated_arrival_date", ["is not null", "is a valid ISO 8601 timestamp", "is not in the past"]),
    ], "2026-01-01 00:00:00")
    assert unknown == []
    got = {r.rule_id: (r.passed, r.failed, r.unknown) for r in ev.evaluate(manifest_df(spark, MANIFEST), rules).collect()}
    assert got == {
        "product_id_1": (9, 1, 0), "product_id_2": (9, 0, 1), "product_id_3": (8, 1, 1),
        "quantity_1": (9, 1, 0), "quantity_2": (8, 1, 1),
        "estimated_arrival_date_1": (10, 0, 0), "estimated_arrival_date_2": (9, 1, 0),
        "estimated_arrival_date_3": (8, 1, 1)}


def test_unknown_phrase_is_reported():
    assert compile_phrase("a", "looks about right", "2026-01-01") is None
    assert phrase_rules([("a", ["is not null", "is nice"])], "2026-01-01")[1] == [("a", "is nice")]
    assert compile_phrase("a", "starts with O'Neil", "2026-01-01") == "startswith(`a`, 'O''Neil')"


def injected(spark, sf):
    return inject(sales_view(spark, sf, ordered_dates=True), SALES_KEYS, SALES_DEFECTS)


def test_counts_add_up(spark, sf):
    df = injected(spark, sf)
    n = df.count()
    for r in ev.evaluate(df, SALES_RULES).collect():
        assert r.passed + r.failed + r.unknown == n == r.n_rows


def test_batches_do_not_change_counts(spark, sf):
    li = load(spark, sf, "lineitem")
    rules = line_rules(23)
    cols = ["rule_id", "passed", "failed", "unknown"]
    whole = rows(ev.evaluate(li, rules), *cols)
    assert rows(ev.evaluate(li, rules, max_rules=4), *cols) == whole
    for r, (rid, _, failed, _) in zip(rules, whole):
        assert r.rule_id == rid and li.where(f"NOT ({r.rule})").count() == failed


def test_batches_follow_text_size():
    rules = [Rule(str(i), CROSS_COLUMN, "x" * 1000) for i in range(5)]
    assert [len(b) for b in ev.batches(rules)] == [2, 2, 1]
    assert [len(b) for b in ev.batches(line_rules(120))][0] <= 50


def test_empty_table_has_a_row_per_rule(spark):
    empty = spark.createDataFrame([], "a int")
    assert rows(ev.evaluate(empty, [Rule("r", "a", "a > 0")]), "n_rows", "passed", "failed", "pass_rate") == [
        (0, 0, 0, None)]


def test_tags_match_counts_in_many_batches(spark, sf):
    df = injected(spark, sf)
    tagged = ev.tag(df, SALES_RULES, max_rules=3)
    counted = {r.rule_id: r.failed for r in ev.evaluate(df, SALES_RULES).collect()}
    seen = {r.id: r.n for r in tagged.select(F.explode(F.split("failed_rules", ",")).alias("id")).where("id <> ''")
            .groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert seen == {k: v for k, v in counted.items() if v}
    one = ev.tag(df, SALES_RULES)
    key = ["transaction_id", "part_key", "failed_rules"]
    assert rows(one, *key) == rows(tagged, *key)


def test_split_is_a_partition_of_the_input(spark, sf):
    df = injected(spark, sf)
    clean, bad = ev.split(df, SALES_RULES)
    assert clean.count() + bad.count() == df.count() and bad.count() > 0
    assert clean.columns == df.columns
    clean2, bad2 = ev.split(df, SALES_RULES, max_rules=2)
    assert rows(bad, "transaction_id", "failed_rules") == rows(bad2, "transaction_id", "failed_rules")
    assert rows(clean, "transaction_id", "part_key") == rows(clean2, "transaction_id", "part_key")


def test_warning_rules_do_not_quarantine(spark):
    df = spark.createDataFrame([(1,), (-1,)], "a int")
    rules = [Rule("w", "a", "a > 0", severity="warning"), Rule("e", "a", "a > -5")]
    assert ev.split(df, rules)[1].count() == 0


def test_written_split_equals_split(spark, sf):
    df = injected(spark, sf)
    path = ev.write_split(df, SALES_RULES, shared_dir(spark, "t"))
    back = spark.read.parquet(path)
    assert back.where("outcome = 'quarantine'").count() == ev.split(df, SALES_RULES)[1].count()
    assert back.count() == df.count()


def test_recall_is_full_and_drops_without_the_rule(spark, sf):
    caught_by = {"negative_quantity": "quantity_range", "ship_before_order": "ship_after_order"}
    full = ev.recall(injected(spark, sf), SALES_RULES, caught_by).collect()
    assert all(r.recall == 1.0 and r.planted > 0 for r in full)
    fewer = [r for r in SALES_RULES if r.rule_id != "quantity_range"]
    left = {r.defect: r.recall for r in ev.recall(injected(spark, sf), fewer, caught_by).collect()}
    assert left == {"negative_quantity": 0.0, "ship_before_order": 1.0}


def test_totals_equal_ungrouped(spark, sf):
    df = injected(spark, sf)
    total = ev.evaluate_by(df, SALES_RULES, ["status"], totals=True).where("status = 'ALL'")
    assert rows(total, "rule_id", "passed", "failed") == rows(ev.evaluate(df, SALES_RULES), "rule_id", "passed", "failed")


def test_only_named_columns_are_read(spark, sf):
    plan = ev.evaluate(load(spark, sf, "lineitem"), [Rule("q", "l_quantity", "l_quantity > 0")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double>" in text


def test_regex_keeps_backslashes(spark):
    assert raw_literals(r"e RLIKE 'a\.b'") == r"e RLIKE r'a\.b'"
    assert raw_literals(r"e RLIKE r'a\.b'") == r"e RLIKE r'a\.b'"
    assert raw_literals("e = 'ab'") == "e = 'ab'"
    df = spark.createDataFrame([("foo@bar.com",), ("foo@barcom",)], "e string")
    got = ev.evaluate(df, [Rule("e", "e", r"e RLIKE '^[a-z]+@[a-z]+\.[a-z]{2,}$'")]).first()
    assert (got.passed, got.failed) == (1, 1)


ADVERSARIAL = [
    ("q > 0 AND (SELECT max(q) FROM t) > 1", "unknown column"), ("exists(SELECT 1)", "function not allowed"),
    ("count(q) > 0", "function not allowed"), ("rank() OVER (ORDER BY q) = 1", "function not allowed"),
    ("java_method('java.lang.System', 'exit', 0) IS NULL", "function not allowed"),
    ("q = current_user", "unknown column"), ("q > 0; DROP TABLE t", "character not allowed"),
    ("q / 0 > 1", "character not allowed"), ("cast(s AS int) > 1", "function not allowed"),
    ("s + 1 > 2", "arithmetic on text"), ("s IN (1, 2)", "compares text with number"),
    ("q BETWEEN 'a' AND 'b'", "compares number with text literal"), ("d > 'yesterday'", "malformed date"),
    ("q IN (SELECT q FROM t)", "unknown column"), ("s = \"a\"", "character not allowed"),
    ("q", "not Boolean"), ("q > ", "does not analyse"), ("s RLIKE 'it\\'s'", "comment or escaped quote"),
    ("q > 1 /* x */", "comment"), ("`q;` > 1", "unknown column"), ("rand() > 0.5", "function not allowed"),
    ("assert_true(q > 1) IS NULL", "function not allowed"), ("b > 1", "compares boolean with number"),
]


@pytest.mark.parametrize("text,why", ADVERSARIAL)
def test_screen_rejects(spark, text, why):
    schema = spark.createDataFrame([], "q int, s string, d date, b boolean").schema
    good, bad = screen(spark, [Rule("r", CROSS_COLUMN, text)], schema)
    assert good == [] and why in bad[0][1]


@pytest.mark.parametrize("text", [
    "q > 0", "q IS NOT NULL OR s = 'x'", "s RLIKE '^[A-Z]+\\.$'", "d >= '2024-01-01'", "d BETWEEN '2024-01-01' AND '2024-02-01'",
    "try_cast(s AS double) > 1", "coalesce(q, 0) * 2 <= 10", "CASE WHEN b THEN q > 0 ELSE true END", "NOT (q < 0)",
    "length(trim(s)) BETWEEN 1 AND 5", "s IN ('a', 'it''s')", "`q` >= -5", "try_divide(q, 2) > 1"])
def test_screen_accepts(spark, text):
    df = spark.createDataFrame([(1, "a", None, True)], "q int, s string, d date, b boolean")
    good, bad = screen(spark, [Rule("r", CROSS_COLUMN, text)], df.schema)
    assert bad == [] and len(good) == 1
    assert ev.evaluate(df, good).first().n_rows == 1


def test_reference_numeric_form_never_fails(spark):
    df = spark.createDataFrame([(1.0, None, 1.0, 1.0, -3), (None, None, 1.0, 1.0, None)],
                               "amount double, x string, original_price double, discount_price double, quantity int")
    for form, failed in (("reference", 0), ("default", 1)):
        rules = [r for r in rules_numeric(SALES_SCHEMA, form) if r.column == "quantity"]
        assert ev.evaluate(df, rules).first().failed == failed


def test_not_null_uses_schema_and_contract():
    assert [r.column for r in rules_not_null(SALES_SCHEMA)] == ["transaction_id"]
    assert [r.column for r in rules_not_null(SALES_SCHEMA, ["status"])] == ["transaction_id", "status"]


def test_rules_round_trip_through_rows(spark):
    assert rules_from(rules_frame(spark, SALES_RULES)) == sorted(SALES_RULES, key=lambda r: r.rule_id)


def test_reference_check_counts_nulls_as_unknown(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k int")
    ref = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    found = check_reference(df, "k", ref, "id")
    assert rows(found.counts, "n_rows", "matched", "orphans", "unknown", "orphan_values") == [(5, 3, 1, 1, 1)]
    assert rows(found.orphans, "k") == [(9,)]


def test_unique_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    found = check_unique(df, ["a", "b"])
    assert rows(found.counts, "n_rows", "n_keys", "repeated_keys", "extra_rows") == [(5, 3, 2, 2)]
    assert found.duplicates.count() == 2


def test_stream_equals_batch(spark, sf):
    rules = [Rule("v", "value", "value <= 50"), Rule("t", "event_type", "event_type <> 'error'")]
    out = shared_dir(spark, "t")
    validate_stream(read_stream(spark, sf, "events"), rules, out)
    stream = spark.read.parquet(f"{out}/rows")
    batch = ev.tag(load(spark, sf, "events"), rules)
    assert rows(stream, "event_id", "failed_rules") == rows(batch, "event_id", "failed_rules")
    # Starting again on the same checkpoint adds nothing.
    validate_stream(read_stream(spark, sf, "events"), rules, out)
    assert spark.read.parquet(f"{out}/rows").count() == batch.count()
