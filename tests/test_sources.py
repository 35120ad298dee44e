import json

import pytest
from pyspark.sql import functions as F

from rulemill.session import checkpointed, shared_dir
from rulemill.sources.manifest import MANIFEST_SCHEMA, manifest_df
from rulemill.sources.payload_log import append_log, read_log, stream_log
from rulemill.sources.sales import SALES_DEFECTS, SALES_KEYS, inject, sales_view
from rulemill.sources.tables import load, load_file, preview, row_count, save
from rulemill.streaming.validate import read_stream
from tests.conftest import rows


def test_typed_literals(spark):
    df = manifest_df(spark, [("CW-P-001", 5, "2026-01-01", "SUP-1", True), (None, None, None, None, None)])
    assert df.schema == MANIFEST_SCHEMA
    assert df.count() == 2


def test_save_and_load_round_trip(spark, sf):
    df = load(spark, sf, "nation")
    name = save(df, "quality", "nations")
    assert rows(spark.table(name), "n_nationkey") == rows(df, "n_nationkey")
    assert load(spark, "quality", "nations").count() == 25
    save(df.limit(3), "quality", "nations")
    assert spark.table(name).count() == 3


def test_saved_tables_lose_nullability(spark):
    schema = "id bigint NOT NULL, v string"
    save(spark.createDataFrame([(1, "a")], schema), "quality", "strict")
    assert spark.table("quality.strict").schema["id"].nullable


def test_load_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"x": 1, "y": "b"}, {"x": 2, "y": "c"}], indent=2))
    (tmp_path / "a.csv").write_text("x,y\n1,b\n02,c\n")
    assert rows(load_file(spark, str(tmp_path / "a.json")), "x", "y") == [(1, "b"), (2, "c")]
    csv = load_file(spark, str(tmp_path / "a.csv"))
    assert dict(csv.dtypes) == {"x": "string", "y": "string"}
    assert rows(csv, "x", "y") == [("02", "c"), ("1", "b")]
    with pytest.raises(ValueError):
        load_file(spark, "a.xml")


def test_preview_is_ordered(spark, sf):
    keys = [r[0] for r in preview(load(spark, sf, "orders"), 7, ["o_orderkey"]).select("o_orderkey").collect()]
    assert keys == list(range(7))
    assert row_count(load(spark, sf, "orders")).first()[0] == load(spark, sf, "orders").count()



def test_log_appends_by_day(spark, sf, tmp_path):
    events = load(spark, sf, "events")
    path = str(tmp_path / "log")
    append_log(events, path)
    append_log(events, path)
    log = read_log(spark, path)
    assert log.count() == 2 * events.count()
    pruned = log.where("day = DATE '2024-01-05'")
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_log_stream_equals_batch(spark, sf, tmp_path):
    stream_log(read_stream(spark, sf, "events"), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    got = read_log(spark, str(tmp_path / "s"))
    assert rows(got, "event_id") == rows(load(spark, sf, "events"), "event_id")
    # A second start finds nothing new.
    stream_log(read_stream(spark, sf, "events"), str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert read_log(spark, str(tmp_path / "s")).count() == got.count()


def test_injection_rates(spark, sf):
    df = inject(sales_view(spark, sf, ordered_dates=True), SALES_KEYS, SALES_DEFECTS)
    n = df.count()
    for d in SALES_DEFECTS:
        share = df.where(F.array_contains(F.split("defects", ","), d.name)).count() / n
        assert abs(share - 1 / d.every) < 0.4 / d.every


def test_shared_dir_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b
    df = checkpointed(spark.range(5), "t")
    assert df.count() == 5 and len(df.inputFiles()) > 0
