import datetime
import random

import pytest
from pyspark.sql import functions as F

from rulemill.operators import sketches as sk
from rulemill.operators import tracking as tr
from rulemill.session import shared_dir
from rulemill.sources.tables import load
from tests.conftest import rows

START = datetime.datetime(2024, 1, 1)
SCHEMA = "trace_id string, span_id long, parent_id long, name string, ts timestamp_ntz, duration double"


def span(trace, i, parent, start, length):
    return trace, i, parent, f"n{i % 3}", START + datetime.timedelta(milliseconds=int(start * 1000)), float(length)


def trees(seed, n=40):
    rng, out = random.Random(seed), []
    for t in range(n):
        size = rng.randint(1, 25)
        ids = [t * 100 + k for k in range(size)]
        out += [span(f"t{t}", i, None if k == 0 else rng.choice(ids[:k]), rng.randint(0, 400) / 4, rng.randint(0, 200) / 4) for k, i in enumerate(ids)]
    return out


def interval(s):
    lo = int((s[4] - START).total_seconds() * 1000)
    return lo, lo + int(s[5] * 1000)


@pytest.mark.parametrize("slot", [1_000_000, 60_000_000, 10**15])
def test_self_time_counts_overlapping_children_once(spark, slot):
    spans = trees(1)
    expected = []
    for s in spans:
        lo, hi = interval(s)
        covered = set()
        for c in spans:
            if c[2] == s[1]:
                a, b = interval(c)
                covered |= set(range(max(a, lo), min(b, hi), 250))
        expected.append((s[1], round(s[5] - len(covered) / 4, 6)))
    got = tr.span_self_time(spark.createDataFrame(spans, SCHEMA), slot)
    assert sorted((r["span_id"], round(r["self_time"], 6)) for r in got.collect()) == sorted(expected)
    assert all(t >= 0 for _, t in expected) and any(t < s[5] for (_, t), s in zip(expected, spans, strict=True))


def test_children_that_overlap_are_no_longer_clamped(spark):
    spans = [span("t", 1, None, 0, 10), span("t", 2, 1, 1, 6), span("t", 3, 1, 2, 6), span("t", 4, 1, 20, 5), span("t", 5, 9, 0, 1)]
    got = {r["span_id"]: r["self_time"] for r in tr.span_self_time(spark.createDataFrame(spans, SCHEMA)).collect()}
    assert got == {1: 3.0, 2: 6.0, 3: 6.0, 4: 5.0, 5: 1.0}


def test_critical_path_against_brute_force(spark):
    spans = trees(2)
    expected = []
    for root in (s for s in spans if s[2] is None):
        at, depth = root, 0
        while at:
            children = [c for c in spans if c[2] == at[1]]
            following = max(children, key=lambda c: (interval(c)[1], c[1]), default=None)
            own = at[5]
            if following:
                own -= max(0, min(interval(at)[1], interval(following)[1]) - max(interval(at)[0], interval(following)[0])) / 1000
            expected.append((root[0], depth, at[1], round(own, 4)))
            at, depth = following, depth + 1
    got = tr.critical_path(spark.createDataFrame(spans, SCHEMA))
    assert rows(got, "trace_id", "depth", "span_id", "own_time") == sorted(expected, key=repr)
    assert max(d for _, d, _, _ in expected) > 3
    assert tr.critical_path(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketches_merge_to_the_exact_profile(spark, sf):
    orders, path = load(spark, sf, "orders"), shared_dir(spark, "t")
    slot = F.pmod("o_orderkey", F.lit(4))
    for k in (0, 1, 2, 3, 3, 1):  # appended twice, a snapshot is replaced
        sk.append_sketches(sk.sketch(orders.where(slot == k), "orders", slot), path)
    sk.append_sketches(sk.sketch(load(spark, sf, "embeddings"), "embeddings", F.lit(None)), path)
    merged = {(r.table_name, r.column_name): r for r in sk.merged_profile(sk.read_sketches(spark, path)).collect()}
    n = orders.count()
    for c in ("o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate"):
        r, exact = merged["orders", c], orders.select(c).distinct().count()
        assert (r.n_rows, r.n_nulls) == (n, 0) and abs(r.n_distinct - exact) <= sk.DISTINCT_ERROR * exact + 1
    r = merged["orders", "o_totalprice"]
    assert r.low == orders.agg(F.min("o_totalprice")).first()[0] and r.high == orders.agg(F.max("o_totalprice")).first()[0]
    for p, q in ((0.25, r.p25), (0.5, r.p50), (0.75, r.p75)):
        assert abs(orders.where(F.col("o_totalprice") <= q).count() / n - p) <= sk.RANK_ERROR
    array = merged["embeddings", "embedding"]
    assert array.n_rows > 0 and array.n_nulls == 0 and array.p50 is None and array.low_text is None


def test_sketch_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, s string, d string")
    one = {r.column_name: r for r in sk.merged_profile(sk.sketch(df, "t", F.col("d"))).collect()}
    assert (one["a"].n_nulls, one["a"].n_distinct, one["a"].p50, one["s"].low_text) == (1, 0, None, None)
    assert sk.sketch(df.limit(0), "t", F.col("d")).count() == 0
