"""Skew-safe helpers against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rulemill.functions.ordering import asof_join, running_index
from rulemill.functions.quantiles import exact_quantiles
from rulemill.sources.tables import load
from tests.conftest import rows


def test_running_index_equals_window(spark, sf):
    e = load(spark, sf, "events")
    want = e.withColumn("idx", F.row_number().over(W.partitionBy("event_type").orderBy("ts", "event_id")))
    for unit in ("month", "hour", "minute"):
        got = running_index(e, ["event_type"], ["ts", "event_id"], F.date_trunc(unit, F.col("ts").cast("timestamp")))
        assert rows(got, "event_id", "idx") == rows(want, "event_id", "idx")


@pytest.mark.parametrize("slot", [1, 64, 10**6])
def test_running_index_with_one_hot_key_and_nulls(spark, slot):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 7 > 0, 0).alias("k"), "id")
    want = df.withColumn("idx", F.row_number().over(W.partitionBy("k").orderBy("id")))
    got = running_index(df, ["k"], ["id"], F.floor(F.col("id") / slot))
    assert rows(got, "id", "idx") == rows(want, "id", "idx")


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_asof_join_equals_brute_force(spark, unit):
    rng = random.Random(3)
    def stamp():
        return f"2024-01-{rng.randint(1, 5):02d} {rng.randint(0, 23):02d}:{rng.choice([0, 30]):02d}:00"
    left = [(i, rng.choice("ab"), stamp()) for i in range(120)]
    right = [(rng.choice("abc"), stamp(), 100 + i, i) for i in range(60)]
    ldf = spark.createDataFrame(left, "id int, k string, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    rdf = spark.createDataFrame(right, "k string, t string, v int, tie int").withColumn("ts", F.to_timestamp("t")).drop("t")
    got = asof_join(ldf, rdf, ["k"], "ts", "v", "tie", unit)
    want = []
    for i, k, t in left:
        seen = [(rt, tie, v) for rk, rt, v, tie in right if rk == k and rt <= t]
        want.append((i, max(seen)[2] if seen else None))
    assert rows(got, "id", "v") == sorted(want, key=repr)


def numbers(spark, n=4000):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(0, 1e6, n // 2), np.full(n // 4, 7.0), rng.integers(0, 5, n // 4)])
    data = [("hot" if i % 3 else f"g{i % 30}", float(v)) for i, v in enumerate(values)]
    data += [("hot", None)] * 5
    return data, spark.createDataFrame(data, "g string, v double").repartition(5)


def test_exact_quantiles_equal_numpy(spark):
    data, df = numbers(spark)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["v"], probs, ("g",)).collect()}
    groups = {g for g, _ in data}
    assert len(got) == len(groups) * len(probs)
    for g in groups:
        values = [v for k, v in data if k == g and v is not None]
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_exact_quantiles_many_columns_without_groups(spark, sf):
    li = load(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice"]
    got = {(r.column_name, r.prob): r.value for r in exact_quantiles(li, cols, [0.1, 0.5]).collect()}
    for c in cols:
        values = [float(r[0]) for r in li.select(c).collect()]
        for p in (0.1, 0.5):
            assert got[(c, p)] == pytest.approx(np.quantile(values, p))


def test_exact_quantiles_of_null_keys_nan_and_empty_groups(spark):
    nan = float("nan")
    data = [(None, 1.0), (None, 3.0), ("a", nan), ("a", 1.0), ("a", 2.0), ("b", None), ("c", nan)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["v"], [0.5, 1.0], ("g",)).collect()}
    assert len(got) == 8 and got[(None, 0.5)] == 2.0 and got[(None, 1.0)] == 3.0
    assert got[("a", 0.5)] == 2.0 and np.isnan(got[("a", 1.0)]) and np.isnan(got[("c", 0.5)])
    assert got[("b", 0.5)] is None and got[("b", 1.0)] is None
    none = exact_quantiles(df.limit(0), ["v"], [0.5]).collect()
    assert [tuple(r) for r in none] == [("v", 0.5, None)]
    assert exact_quantiles(df.limit(0), ["v"], [0.5], ("g",)).collect() == []


def test_profiles_count_nulls_of_arrays(spark):
    from rulemill.operators import profile as pf
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (2, []), (4, None)], "id int, v array<double>")
    for approx in (True, False):
        got = {r["column_name"]: r for r in pf.profile(df, "t", approx).collect()}
        assert set(got) == {"id", "v"} and got["id"]["n_distinct"] == 3 and got["id"]["max_value"] == "4"
        assert (got["v"]["n_rows"], got["v"]["n_nulls"], got["v"]["null_rate"]) == (4, 2, 0.5)
        assert all(got["v"][c] is None for c in ("n_distinct", "min_value", "max_value", "mean"))


def test_catalogue_has_all_columns_of_all_tables(spark, sf):
    import os
    from rulemill.plans.profiling import TABLE_COLUMNS
    tables = {f.removesuffix(".parquet") for f in os.listdir(sf) if f.endswith(".parquet")}
    assert tables == set(TABLE_COLUMNS) and len(tables) == 14
    for t in tables:
        assert spark.read.parquet(f"{sf}/{t}.parquet").columns == list(TABLE_COLUMNS[t])
