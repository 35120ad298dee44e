import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulemill.operators import documents as dc
from rulemill.operators import payloads as pl
from rulemill.operators import tracking as tr
from rulemill.operators import vectors as vc
from rulemill.operators import versions as ve
from rulemill.session import shared_dir
from rulemill.sources.tables import load
from rulemill.streaming.sync import current_index, sync_stream
from rulemill.streaming.usage import drain, usage_stream
from rulemill.streaming.validate import read_stream
from tests.conftest import rows


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_versions_continue_and_stay(spark):
    first = ve.register(None, spark.createDataFrame(
        [("a", at(1), 1), ("a", at(2), 2), ("b", at(1), 3)], "name string, ts timestamp, request_id int"))
    more = ve.register(first, spark.createDataFrame(
        [("a", at(3), 4), ("c", at(3), 5), ("a", at(3), 6)], "name string, ts timestamp, request_id int"))
    assert rows(more, "name", "version") == [("a", 3), ("a", 4), ("c", 1)]
    many = spark.range(12).select(F.lit("a").alias("name"), (F.col("id") + 1).alias("version"))
    assert ve.latest_versions(many).first().version == 12


def test_register_prompt_keeps_text_and_tags(spark):
    one = ve.register_prompt(None, "p", "Look at {{table}}", "first", {"team": "dq"}, spark, at(1))
    two = ve.register_prompt(one, "p", "Look hard at {{table}}", "second", {}, spark, at(2))
    both = {r.version: r for r in one.unionByName(two).collect()}
    assert both[1].tags == {"team": "dq"} and both[2].commit_message == "second"


def alias_log(spark):
    return spark.createDataFrame(
        [("m", "champion", at(1), 1, 1), ("m", "champion", at(3), 2, 2), ("m", "champion", at(5), 2, 3),
         ("m", "staging", at(2), 2, 4)], "name string, alias string, ts timestamp, version int, request_id int")


def test_alias_resolution(spark):
    refs = spark.createDataFrame(
        [(1, "models:/m@champion", at(2)), (2, "models:/m@champion", at(3)), (3, "models:/m@champion", at(9)),
         (4, "prompts:/m@staging", at(1)), (5, "models:/m/7", at(1)), (6, "models:/zz@champion", at(9))],
        "id int, uri string, ts timestamp")
    assert rows(ve.resolve(refs, alias_log(spark)), "id", "version") == [
        (1, 1), (2, 2), (3, 2), (4, None), (5, 7), (6, None)]


def test_rollback_skips_repeats(spark):
    assert rows(ve.rollback_target(alias_log(spark)), "alias", "current_version", "rollback_version") == [
        ("champion", 2, 1), ("staging", 2, 0)]


def test_promotion_policies(spark):
    runs = spark.createDataFrame([(1, 2.0, 6.0), (2, 1.0, 4.0), (3, 12.0, 9.0)],
                                 "run_id int, latency_seconds double, rules_generated double")
    versions = spark.createDataFrame([("m", 1, 1), ("m", 2, 2), ("m", 3, 3), ("n", 3, 1)],
                                     "name string, run_id int, version int")
    cols = ("name", "decision", "run_id", "version")
    assert rows(tr.promote(runs, versions), *cols) == [("m", "promote", 1, 1), ("n", "no candidate", -1, 0)]
    assert rows(tr.promote(runs, versions, "latest"), *cols)[0] == ("m", "promote", 1, 3)


def test_compare_runs_missing_is_na(spark):
    log = spark.createDataFrame([(1, "x", 1.0, at(1)), (1, "x", 2.0, at(2)), (2, "y", 3.0, at(1))],
                                "run_id int, key string, value double, ts timestamp")
    assert rows(tr.compare_runs(log, 1, 2), "metric", "run_a", "run_b") == [("x", "2.0000", "N/A"), ("y", "N/A", "3.0000")]


def test_rate_limit_with_one_hot_key(spark):
    log = spark.range(500).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        (F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7)).alias("ts"))
    got = pl.rate_limit(log, 100, "day", ["key"])
    assert got.where("limited").count() == 333 - 100
    assert got.where("NOT limited AND key = 'hot'").agg(F.max("event_id")).first()[0] < got.where(
        "limited").agg(F.min("event_id")).first()[0]


def test_pair_turns_with_gaps(spark):
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 5, "assistant", "a"), (1, 9, "user", "r"), (1, 2000, "user", "s"),
                                (1, 2001, "assistant", "t")], "c int, turn int, role string, text string")
    assert rows(pl.pair_turns(df, "c", "turn", "role", "text"), "turn", "response") == [(0, "a"), (2000, "t"), (9, None)]


def test_chunks_cover_the_text(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    got = dc.chunk(docs, "doc_id", "text", 50, 10)
    parts = {}
    for r in got.orderBy("doc_id", "chunk_no").collect():
        parts.setdefault(r.doc_id, []).append(r.chunk_text.split(" "))
    for doc_id, text in docs.collect():
        words = text.split()
        glued = parts[doc_id][0] + [w for p in parts[doc_id][1:] for w in p[10:]]
        assert glued == words
    chars = dc.chunk(docs, "doc_id", "text", 100, 0, "chars")
    glued = chars.groupBy("doc_id").agg(F.sum(F.length("chunk_text")).alias("n"))
    assert glued.join(docs, "doc_id").where("n <> length(text)").count() == 0
    with pytest.raises(ValueError):
        dc.chunk(docs, "doc_id", "text", 10, 10)


def test_silver_keeps_one_copy_of_a_hot_text(spark):
    df = spark.range(300).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "same  text").otherwise(
        F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = dc.silver(df, "k", "text")
    assert got.count() == 201
    assert rows(got.where("clean_text = 'same text'"), "k") == [(0,)]
    assert dc.silver(spark.createDataFrame([(1, " \n ")], "k int, text string"), "k", "text").count() == 0


def test_strip_markup(spark):
    html = "<p>a &lt;b&gt;</p><script>var x='</p>';</script><!-- c --><STYLE>p{}</STYLE>d&amp;lt;"
    got = spark.createDataFrame([(html,)], "h string").select(dc.clean_text(dc.strip_markup(F.col("h")))).first()[0]
    assert got == "a <b> d&lt;"


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string").withColumn("content_hash", F.sha2("v", 256))


def test_sync_makes_index_equal_source(spark):
    source = frame(spark, [(1, "a"), (2, "new"), (4, "d")])
    index = frame(spark, [(1, "a"), (2, "old"), (3, "c")])
    assert rows(dc.sync_plan(source, index, "k"), "k", "action") == [(2, "update"), (3, "delete"), (4, "insert")]
    assert rows(dc.apply_sync(source, index, "k"), "k", "v") == rows(source, "k", "v")
    assert rows(dc.sync_status(source, index, "k"), "missing", "stale", "orphaned", "ready") == [(1, 1, 1, False)]
    assert dc.sync_status(source, source, "k").first().ready


def test_upsert_last_change_wins(spark):
    index = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    changes = spark.createDataFrame(
        [(1, "x", 1, "upsert"), (1, None, 2, "delete"), (2, "y", 3, "upsert"), (3, "z", 4, "delete"), (3, "w", 5, "upsert")],
        "k int, v string, seq int, op string")
    assert rows(dc.upsert(index, changes, "k", "seq"), "k", "v") == [(2, "y"), (3, "w")]


def test_stream_sync_over_several_batches(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    src = str(tmp_path / "in")
    out = shared_dir(spark, "sync")
    for step in range(3):
        (spark.range(10).select(F.col("id").alias("k"), (F.col("id") + 100 * step).alias("v"),
                                (F.col("id") + 1000 * step).alias("seq"),
                                F.when(F.col("id") == step, "delete").otherwise("upsert").alias("op"))
         .coalesce(1).write.mode("append").parquet(src))
        stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        sync_stream(stream, out, "k", "seq")
    base = spark.createDataFrame([(2, -1), (77, 77)], schema)
    assert rows(current_index(spark, base, out, stream.schema, "k", "seq"), "k", "v") == sorted(
        [(k, 200 + k) for k in range(10) if k != 2] + [(77, 77)], key=repr)


def test_stream_usage_counts_each_closed_window_once(spark, sf):
    out = shared_dir(spark, "usage")
    drain(usage_stream(read_stream(spark, sf, "events"), "1 day", "1 hour", ["event_type"], "value"), out)
    got = spark.read.parquet(f"{out}/rows").select(F.col("window_start").cast("date").alias("d"), "event_type", "calls")
    batch = load(spark, sf, "events").groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("calls"))
    last = batch.agg(F.max("d")).first()[0]
    assert rows(got, "d", "event_type", "calls") == rows(batch.where(F.col("d") < F.lit(last)), "d", "event_type", "calls")


def brute(q, c, k):
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    c = c / np.linalg.norm(c, axis=1, keepdims=True)
    scores = np.round(q @ c.T, 6)
    return {(i, int(j), r + 1) for i, row in enumerate(scores)
            for r, j in enumerate(np.lexsort((np.arange(len(c)), -row))[:k])}


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(6, 12))
    vecs = centers[rng.integers(0, 6, 400)] + 0.4 * rng.normal(size=(400, 12))
    vecs[50:70] = vecs[50]                      # a group of copies
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, v array<double>")
    return vecs, df.repartition(7, "id")


@pytest.mark.parametrize("options", [{}, {"block_rows": 90}, {"block_rows": 17}])
def test_topk_equals_brute_force(spark, cloud, options):
    vecs, df = cloud
    got = vc.topk(df, df, 9, "id", "v", "id", "v", **options)
    assert {(r.query_id, r.id, r.rank) for r in got.collect()} == brute(vecs, vecs, 9)


def test_rows_sent_to_blocks_grow_with_the_input():
    def sent(n, cells=1, asked=1):  # vectors of both sides, each as often as it is sent
        held = vc._block_rows([n * asked // cells, n // cells], 64, vc.BLOCK_ROWS)
        q, c = -(-n * asked // cells // held), -(-n // cells // held)
        return n * asked * c + n * q
    for options in ({}, {"cells": 8, "asked": 4}):
        assert sent(720_000, **options) <= 6.1 * sent(120_000, **options) <= 6.1 * 33 * 120_000
    assert vc._block_rows([50_000_000], 64, vc.BLOCK_ROWS) * 64 == vc.BLOCK_VALUES
    assert vc._block_rows([900], 64, vc.BLOCK_ROWS) == vc.BLOCK_ROWS


def test_nearest_equals_a_full_sort_with_ties():
    rng = np.random.default_rng(3)
    scores = rng.normal(size=(20, 1000)) * 0.2
    scores[:, 100:400] = np.round(scores[:, 100:400], 2)
    scores[3] = 0.0
    scores[4, ::7] = 0.9 + rng.uniform(-4e-7, 4e-7, 143)  # equal when rounded
    scores[5, 17] = np.nan
    for k in (1, 10, 200):
        query, place, value = vc._nearest(scores, k)
        for i in range(20):
            rounded = np.round(scores[i], 6) + 0.0
            expected = np.lexsort((np.arange(1000), -rounded))[:k]
            assert place[query == i].tolist() == expected.tolist()
            assert value[query == i].tolist() == rounded[expected].tolist()


def test_float_vectors_find_what_double_ones_find(spark, cloud):
    _, df = cloud
    floats = df.withColumn("v", F.col("v").cast("array<float>"))
    doubles = floats.withColumn("v", F.col("v").cast("array<double>"))
    assert dict(vc._cells(floats, "id", "v").dtypes)["vec"] == "array<float>"
    got = [rows(vc.topk(d, d, 5, "id", "v", "id", "v", block_rows=30), "query_id", "id", "score", "rank") for d in (floats, doubles)]
    assert got[0] == got[1]


def test_topk_with_fewer_items_than_k(spark, cloud):
    _, df = cloud
    few = df.where("id < 3")
    assert vc.topk(df.where("id < 2"), few, 10, "id", "v", "id", "v").count() == 6


def test_text_ids_and_repeated_ids(spark):
    rng = np.random.default_rng(5)
    vecs = rng.normal(size=(60, 5))
    ids = [f"i{k % 40:02d}" for k in range(60)]  # twenty ids twice
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vecs, strict=True)] + [("none", None)], "id string, v array<double>")
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    best = {}
    for a, p in zip(ids, unit, strict=True):
        for b, q in zip(ids, unit, strict=True):
            best[a, b] = max(best.get((a, b), -2.0), round(float(p @ q), 6))
    expected = {(a, b, r + 1) for a in set(ids) for r, b in enumerate(sorted(set(ids), key=lambda x: (-best[a, x], x))[:7])}
    items = df.withColumnRenamed("id", "item")
    for rows_of in (1000, 9):
        got = vc.topk(df, items, 7, "id", "v", "item", "v", block_rows=rows_of)
        assert {(r.query_id, r.item, r["rank"]) for r in got.collect()} == expected
    got = vc.ann_topk(df, items, 7, "id", "v", "item", "v", n_cells=4, n_probe=4)
    assert {(r.query_id, r.item, r["rank"]) for r in got.collect()} == expected


def test_ann_recall(spark, cloud):
    vecs, df = cloud
    exact = brute(vecs, vecs, 9)
    def recall(probe, **options):
        got = vc.ann_topk(df, df, 9, "id", "v", "id", "v", n_cells=8, n_probe=probe, **options)
        pairs = {(r.query_id, r.id) for r in got.collect()}
        return len(pairs & {(a, b) for a, b, _ in exact}) / len(exact)
    assert recall(8) == 1.0
    assert recall(3) > 0.8
    large = {"block_rows": 40}
    assert recall(8, **large) == 1.0
    assert recall(3, **large) == recall(3)


def test_retriever_finds_the_rule_itself(spark):
    rules = spark.createDataFrame([(1, "quantity must be positive"), (2, "email has an at sign"),
                                   (3, "ship date follows order date")], "rule_id long, rule string")
    found = vc.Retriever.from_texts(rules).search_historical_rules(
        rules.select(F.col("rule_id").alias("q"), "rule"), "q", "rule", 1)
    assert rows(found, "q", "rule_id", "score") == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]


def test_drift_is_zero_for_equal_halves(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("v"), (F.col("id") >= 500).alias("cur"))
    got = pl.drift(df, F.col("cur"), "v", [2.0, 5.0]).first()
    assert got.psi == 0.0 and got.mean_shift == 0.0
    moved = df.withColumn("v", F.when(F.col("cur"), F.col("v") + 5).otherwise(F.col("v")))
    assert pl.drift(moved, F.col("cur"), "v", [2.0, 5.0]).first().psi > 0.5


def test_eval_set_is_repeatable(spark, sf):
    df = load(spark, sf, "documents").select("doc_id", "lang")
    a = rows(pl.eval_set(df, ["lang"], "doc_id", 3), "doc_id", "lang")
    assert a == rows(pl.eval_set(df.repartition(7), ["lang"], "doc_id", 3), "doc_id", "lang")
    assert len(a) == 3 * df.select("lang").distinct().count()
