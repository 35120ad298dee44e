import datetime
import random

from pyspark.sql import functions as F

from rulemill.operators import payloads as pl
from rulemill.session import shared_dir
from rulemill.sources.tables import load
from rulemill.streaming import usage as us
from rulemill.streaming.limits import limit_stream, session_for_state
from rulemill.streaming.validate import read_stream
from tests.conftest import rows

START = datetime.datetime(2024, 1, 1)
SCHEMA = "id long, k string, v double, ts timestamp_ntz"


def calls(rng, n, hours):
    return [(i, rng.choice(["a", "a", "a", "b", None]), 1.0, START + datetime.timedelta(milliseconds=rng.randrange(hours * 3_600_000))) for i in range(n)]


def deliver(spark, folder, part):
    spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(folder)


def test_closed_and_open_windows_are_all_windows(spark, sf):
    for session in (False, True):
        out = shared_dir(spark, "t")
        stream = read_stream(spark, sf, "events")
        us.drain(us.session_stream(stream, "6 hours", "2 hours", ["user_id"], "value") if session else us.usage_stream(stream, "1 hour", "2 hours", ["user_id"], "value"), out)
        found = us.all_windows(spark, out, ["user_id"])
        assert found.where("NOT closed").count() > 0
        assert found.agg(F.sum("calls")).first()[0] == load(spark, sf, "events").count()
        if not session:
            whole = pl.usage_windows(load(spark, sf, "events"), "1 hour", ["user_id"], "value")
            shown = found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))
            assert rows(shown, "window_start", "user_id", "calls") == rows(whole, "window_start", "user_id", "calls")


def test_open_windows_follow_a_second_delivery(spark):
    rng, out = random.Random(1), shared_dir(spark, "t")
    whole = sorted(calls(rng, 200, 48), key=lambda r: r[3])  # in order of time, so nothing is late
    for part in (whole[:100], whole[100:]):
        deliver(spark, f"{out}/in", part)
        us.drain(us.usage_stream(spark.readStream.schema(SCHEMA).parquet(f"{out}/in"), "1 hour", "1 hour", ["k"], "v"), f"{out}/o")
    got = us.all_windows(spark, f"{out}/o", ["k"])
    assert got.agg(F.sum("calls")).first()[0] == 200 and got.where("NOT closed").count() > 0
    assert got.groupBy("window_start", "k").count().where("count > 1").count() == 0


def test_late_rows_are_kept_apart_and_replay_changes_nothing(spark):
    rng, out = random.Random(2), shared_dir(spark, "t")
    parts = [calls(rng, 100, 24), calls(rng, 100, 60), [(900, "a", 1.0, None)] + calls(rng, 50, 60)]
    parts = [[(i + 1000 * n, *r) for i, *r in part] for n, part in enumerate(parts)]
    expected, newest = [], None
    for part in parts:
        deliver(spark, f"{out}/in", part)
        us.split_late(spark.readStream.schema(SCHEMA).parquet(f"{out}/in"), f"{out}/o", "5 hours")
        expected += [(i, bool(newest and t and t < newest - datetime.timedelta(hours=5))) for i, _, _, t in part]
        newest = max([t for *_, t in part if t] + ([newest] if newest else []))
    schema = spark.createDataFrame([], SCHEMA).schema
    got = us.read_split(spark, f"{out}/o", schema)
    assert rows(got, "id", "late") == sorted(expected, key=repr) and got.where("late").count() > 10
    us.split_late(spark.readStream.schema(SCHEMA).parquet(f"{out}/in"), f"{out}/o", "5 hours")
    assert us.read_split(spark, f"{out}/o", schema).count() == len(expected)


def brute_limit(data, n, period, slots):
    width, out = period // slots, []
    for i, k, _, t in data:
        if k is None or t is None:
            continue
        ms = int((t - datetime.datetime(1970, 1, 1)).total_seconds() * 1000 + 0.5)
        own = [(x, y) for x, kk, _, tt in data if kk == k and tt is not None for y in [int((tt - datetime.datetime(1970, 1, 1)).total_seconds() * 1000 + 0.5)]]
        number = sum((y, x) <= (ms, i) and ms // width - slots < y // width for x, y in own)
        out.append((i, number, number > n))
    return sorted(out, key=repr)


def test_sliding_limit_against_brute_force(spark):
    data = calls(random.Random(3), 150, 30) + [(900, "a", 1.0, None)]
    got = pl.sliding_limit(spark.createDataFrame(data, SCHEMA), 3, 4 * 3_600_000, 4, "k", "id")
    assert rows(got, "id", "call_no", "limited") == brute_limit(data, 3, 4 * 3_600_000, 4)


def test_stream_limit_equals_batch_over_restarts(spark):
    data, out = sorted(calls(random.Random(4), 180, 40), key=lambda r: (r[3], r[0])), shared_dir(spark, "t")
    own = session_for_state(spark)
    for k in range(0, 180, 60):
        deliver(spark, f"{out}/in", data[k:k + 60])
        limit_stream(own.readStream.schema(SCHEMA).parquet(f"{out}/in"), 3, 4 * 3_600_000, 4, "k", "id", f"{out}/o")
    got = spark.read.parquet(f"{out}/o/rows")
    assert rows(got, "id", "call_no", "limited") == brute_limit(data, 3, 4 * 3_600_000, 4)
    limit_stream(own.readStream.schema(SCHEMA).parquet(f"{out}/in"), 3, 4 * 3_600_000, 4, "k", "id", f"{out}/o")
    assert spark.read.parquet(f"{out}/o/rows").count() == got.count()
