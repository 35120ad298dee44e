import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rulemill.operators import agent as ag
from rulemill.operators import inference as inf
from rulemill.operators import mining as mi
from rulemill.operators import profile as pf
from rulemill.operators import prompts as pr
from rulemill.operators import rulesets as rs
from rulemill.operators.evaluate import evaluate
from rulemill.sources.tables import load
from tests.conftest import rows

GOOD = '{"column": "a", "rule": "a > 0"}'
CASES = {
    "plain": (f"[{GOOD}]", [("a", "a > 0", "llm")]),
    "fenced": (f"```json\n[{GOOD}]\n```", [("a", "a > 0", "llm")]),
    "fence_no_newline": (f"```[{GOOD}]```", [("a", "a > 0", "llm")]),
    "object": (GOOD, [("a", "a > 0", "llm")]),
    "prose": ("I cannot help", [("_parse_error", "I cannot help", "llm")]),
    "number_in_list": (f"[3, {GOOD}]", [(None, None, None), ("a", "a > 0", "llm")]),
    "no_rule": ('[{"column": "a"}]', [("a", None, "llm")]),
    "empty": ("[]", []),
    "own_source": ('[{"column": "a", "rule": "a > 0", "source": "schema"}]', [("a", "a > 0", "schema")]),
    "scalar": ("42", [("_parse_error", "42", "llm")]),
    "null": ("null", [("_parse_error", "null", "llm")]),
    "cut_off": ('[{"column": "a", "ru', [("_parse_error", '[{"column": "a", "ru', "llm")]),
    "blank": ("  ", [("_parse_error", "", "llm")]),
    "nested": ("[[1]]", [(None, None, None)]),
}


def test_parse_responses_golden(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "response_id string, raw string")
    got = {}
    for r in rs.parse_responses(df, "raw").orderBy("response_id", "pos").collect():
        got.setdefault(r.response_id, []).append((r["column"], r.rule, r.source))
    assert {k: got.get(k, []) for k in CASES} == {k: v[1] for k, v in CASES.items()}


def test_missing_text_is_a_parse_error(spark):
    df = spark.createDataFrame([("x", None)], "response_id string, raw string")
    assert rs.parse_responses(df, "raw").first()["column"] == "_parse_error"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.text(max_size=30),
    st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=5),
                 lambda c: st.lists(c, max_size=3) | st.dictionaries(st.sampled_from(["column", "rule", "x"]), c),
                 max_leaves=6).map(json.dumps)), min_size=1, max_size=40))
def test_parse_never_raises_and_keeps_every_item(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "response_id int, raw string")
    parsed = rs.parse_responses(df, "raw")
    good, bad = rs.validate_rules(parsed)
    assert good.count() + bad.count() == parsed.count()
    lone = [i for i, t in enumerate(texts) if t.strip() not in ("[]", "```[]```")]
    seen = {r[0] for r in parsed.select("response_id").distinct().collect()}
    assert {i for i in lone if not _is_empty_list(texts[i])} <= seen


def _is_empty_list(t):
    try:
        return json.loads(t.strip().strip("`")) == []
    except ValueError:
        return False


def test_validate_gives_reasons(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "response_id string, raw string")
    good, bad = rs.validate_rules(rs.parse_responses(df, "raw"))
    assert rows(bad, "response_id", "reason") == [
        ("nested", "not an object"), ("no_rule", "missing rule"), ("number_in_list", "not an object")]
    assert good.where("column IS NULL OR rule IS NULL").count() == 0


def test_gate_counts_rules_not_rows(spark):
    df = spark.createDataFrame([("t", "a"), ("t", "b"), ("u", "_parse_error"), ("u", "a"), ("u", "b")],
                               "table_name string, column string")
    assert rows(rs.gate(df, "table_name", 2), "table_name", "n_rules", "n_errors", "passed") == [
        ("t", 2, 0, True), ("u", 2, 1, False)]
    assert rs.gate(df, "table_name", 3).where("passed").count() == 0


NESTED = inf.CANNED_YAML


def test_flatten_documents(spark):
    df = spark.createDataFrame([(1, NESTED), (2, "rules: ["), (3, "a: 1"), (4, "rules: []"), (5, None)], "id int, doc string")
    good, bad = rs.flatten_documents(df, "id", "doc")
    assert good.where("id = 1").count() == 7
    assert good.where("id = 1").select("column").distinct().count() == 3
    assert {r.id for r in bad.collect()} == {2, 3, 5}
    metrics = rs.rule_metrics(good.withColumn("source", F.lit("llm")), "id").where("id = 1").first()
    assert (metrics.rules_generated, metrics.column_groups) == (7, 3)


def test_flatten_all_reads_each_document_once_in_many_tasks(spark, tmp_path):
    docs = spark.range(0, 60_000, 1, 1).select("id", F.when(F.col("id") % 4 == 0, F.concat(F.lit("word "), F.col("id").cast("string"))).when(
        F.col("id") % 4 == 1, NESTED).when(F.col("id") % 4 == 2, F.concat(F.lit("rules: [{column: c, rules: [r"), F.col("id").cast("string"), F.lit("]}]"))).alias("doc"))
    log = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        log.add(1)
        return text

    out = rs.flatten_all(docs.withColumn("doc", counted("doc")), "id", "doc")
    out.write.parquet(str(tmp_path / "out"))
    assert log.value == 60_000
    got = spark.read.parquet(str(tmp_path / "out"))
    assert "REPARTITION_BY_COL" in out._jdf.queryExecution().executedPlan().toString()
    assert got.where("id % 4 = 1").count() == 7 * 15_000
    assert rows(got.where("id IN (0, 2, 3)"), "id", "group_pos", "column", "rule_pos", "rule") == sorted(
        [(0, -1, None, -1, "TypeError"), (2, 0, "c", 0, "r2"), (3, -1, None, -1, "AttributeError")], key=repr)
    good, bad = rs.flatten_documents(docs.where("id < 400"), "id", "doc")
    assert good.count() == 8 * 100 and bad.count() == 200


def test_summary_equals_spark_s_without_casting_plain_text(spark, sf):
    texts = ["1.5", " 2 ", "\t-3e2\n", "+.5", "5.", "1d", "2F", "0x1p3", "NaN", "-nan", "inf", "-Infinity", "infinit", "1e", "e5", ".", "", "-", "CW-P-1", "1998-01-02",
             "1998-01-02T14:00:00Z", "1 2", "1,5", "\u00a07", "\u00057", "7\u0085", "٣", "1e400", "\x7f8", None]
    frames = [spark.createDataFrame([(t, k) for k, t in enumerate(texts)], "a string, n int")]
    frames += [spark.createDataFrame([(t, None)], "a string, n int") for t in texts]
    one = frames[1]
    for f in frames[2:]:
        one = one.unionByName(f)
    for df in (frames[0], one, one.limit(0), load(spark, sf, "supplier"), spark.range(3)):
        assert [tuple(map(str, r)) for r in pf.summary(df).collect()] == [tuple(map(str, r)) for r in df.summary().collect()]
        assert pf.summary(df).columns == df.summary().columns
    judged = one.select("a", F.col("a").try_cast("double").isNotNull().alias("number"), F.col("a").rlike(pf._MAY_BE_NUMBER).alias("tried"))
    assert judged.where("number AND NOT tried").count() == 0
    assert {r.a for r in judged.where("NOT tried").collect()} >= {"CW-P-1", "1998-01-02", "1998-01-02T14:00:00Z", "1,5"}


def test_novel_rules_ignore_case_and_blanks(spark):
    new = spark.createDataFrame([("A", "a  >  0"), ("a", "A > 0"), ("a", "a > 1")], "column string, rule string")
    known = spark.createDataFrame([("a", "a > 0")], "column string, rule string")
    assert rows(rs.novel_rules(new, known), "rule_key") == [("a > 1",)]


def test_rules_json_collapses_duplicates(spark):
    df = spark.createDataFrame([("t", "a", "a > 0", "llm")] * 50 + [("t", "b", "b > 0", "llm")],
                               "table_name string, column string, rule string, source string")
    got = rs.rules_json(df).first()
    assert got.n_rules == 2
    assert [r["column"] for r in json.loads(got.rules_json)] == ["a", "b"]


def test_mined_rules_have_the_support_they_claim(spark, sf):
    orders = load(spark, sf, "orders")
    from rulemill.functions.rules import Rule
    enums = mi.mine_enums(orders, ["o_orderstatus", "o_orderkey"], 10).collect()
    assert [r.column_name for r in enums] == ["o_orderstatus"]
    assert evaluate(orders, [Rule("e", "o_orderstatus", enums[0].rule)]).first().failed == 0
    shapes = mi.mine_formats(orders, "o_orderpriority", 10).collect()
    for s in shapes:
        assert orders.where(F.col("o_orderpriority").rlike(s.regex)).count() == s.n
    fence = mi.mine_outliers(load(spark, sf, "events"), ["value"]).first()
    rule = mi.outlier_rules(mi.mine_outliers(load(spark, sf, "events"), ["value"]))
    assert evaluate(load(spark, sf, "events"), rule).first().failed == fence.n_below + fence.n_above > 0


def test_quoted_enum_values(spark):
    df = spark.createDataFrame([("it's",), ("b",)], "s string")
    assert mi.mine_enums(df, ["s"], 5).first().rule == "s IN ('b', 'it''s')"


def test_summary_parity(spark, sf):
    got = {r["summary"]: r for r in pf.summarize(load(spark, sf, "part")).collect()}
    assert list(got) == ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    assert got["count"]["p_size"] == str(load(spark, sf, "part").count())


def test_approximate_profile_is_close(spark, sf):
    exact = {r.column_name: r.n_distinct for r in pf.profile(load(spark, sf, "orders"), "o", approx=False).collect()}
    for r in pf.profile(load(spark, sf, "orders"), "o").collect():
        assert abs(r.n_distinct - exact[r.column_name]) <= 0.15 * exact[r.column_name] + 1


def test_profile_history_appends(spark, sf, tmp_path):
    for day in ("2026-01-01", "2026-01-02"):
        pf.append_history(pf.profile_tables(spark, {"nation": load(spark, sf, "nation")}, day), str(tmp_path / "h"))
    assert spark.read.parquet(str(tmp_path / "h")).groupBy("snapshot").count().count() == 2


def test_sample_rows_are_json(spark, sf):
    got = pf.sample_rows(load(spark, sf, "nation"), 5, ["n_nationkey"]).collect()
    assert [json.loads(r.row_json)["n_nationkey"] for r in got] == [0, 1, 2, 3, 4]


def test_render_leaves_placeholder_like_values_alone(spark):
    df = spark.createDataFrame([("{{a}} and {{b}} and {{c}}", "{{b}}", "x")], "t string, a string, b string")
    got = pr.render(df, "t", {"a": F.col("a"), "b": F.col("b")}).first()
    assert got.rendered == "{{b}} and x and {{c}}"
    assert got.unresolved == "c"
    one = spark.createDataFrame([("{a} {{b}}", "v")], "t string, a string")
    assert pr.render(one, "t", {"a": F.col("a")}, "single").first().rendered == "v {{b}}"


def test_fingerprint(spark):
    import hashlib
    df = spark.createDataFrame([("héllo",)], "p string")
    got = pr.with_fingerprint(df, "p").first()
    assert got.prompt_hash == hashlib.sha256("héllo".encode()).hexdigest()[:12]
    assert got.prompt_length == 5


class Flaky:
    built = 0

    def generate_rules(self, prompt):
        if "bad" in prompt:
            raise RuntimeError("refused")
        return f"[{GOOD}]"


def test_infer_keeps_errors_by_row(spark):
    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "good")], "id int, prompt string")
    got = inf.infer(df, "prompt", Flaky)
    assert rows(got.where("error IS NULL"), "id") == [(1,), (3,)]
    assert rows(got.where("error IS NOT NULL"), "id", "error") == [(2, "RuntimeError: refused")]


def test_prompt_with_retrieved_rules(spark):
    cols = spark.createDataFrame([("t", 0, "a", "int", True)], pf.SCHEMA_COLUMNS)
    rules = spark.createDataFrame([("t", "a > 0"), ("t", "a > 0")], "table_name string, rule string")
    found = spark.createDataFrame([("t", "a is small")], "table_name string, rule string")
    prompt = pr.build_prompts(cols, rules, "x > 1", found).first().prompt
    assert prompt.count("- a > 0") == 1 and "- a is small" in prompt and "- a (int, nullable=true)" in prompt
    assert "similar tables" not in pr.build_prompts(cols, rules, "x > 1").first().prompt


@pytest.mark.parametrize("text,want", [("AB-12", "^[A-Za-z][A-Za-z]\\-[0-9][0-9]$"), ("a.b*", None)])
def test_format_regex_matches_itself(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    got = mi.mine_formats(df, "s", 1).first()
    assert df.where(F.col("s").rlike(got.regex)).count() == 1
    if want:
        assert got.regex == want


class Counting:
    """Writes a file for every prompt it is asked."""

    folder = ""

    def __init__(self, folder):
        self.folder = folder

    def generate_rules(self, prompt):
        import os
        import uuid
        open(os.path.join(self.folder, uuid.uuid4().hex), "w").close()
        if "bad" in prompt:
            raise ValueError("no answer")
        return '[{"column": "a", "rule": "a > 0"}, {"column": "b"}, 7]'


class Batched(Counting):
    def generate_batch(self, prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("batch failed")
        return [self.generate_rules(p) for p in prompts]


@pytest.mark.parametrize("kind", [Counting, Batched])
def test_each_prompt_is_asked_once(spark, tmp_path, kind):
    folder = str(tmp_path)
    prompts = spark.createDataFrame([(f"t{k}", f"prompt {k}") for k in range(9)] + [("t9", "bad prompt")], "table_name string, prompt string")
    judged = ag.answers(prompts, lambda: kind(folder), batch_size=4, partitions=2)
    kept, lost = judged.where("reason IS NULL"), judged.where("reason IS NOT NULL")
    assert kept.count() == 9 and lost.count() == 19
    assert {r["reason"] for r in lost.collect()} == {"missing rule", "not an object", "failed prompt"}
    assert [r["rule"] for r in lost.where("reason = 'failed prompt'").collect()] == ["ValueError: no answer"]
    assert len(list(tmp_path.iterdir())) == 10


def test_an_empty_rule_list_is_no_error(spark):
    from rulemill.operators import evaluate as ev
    df = spark.createDataFrame([(1, "x")], "a int, k string")
    assert ev.evaluate(df, []).collect() == [] and ev.evaluate_by(df, [], ["k"]).collect() == []
    card = ev.scorecard(df, [], "t").first()
    assert card["rule_coverage"] == 0.0 and card["n_rules"] == 0
