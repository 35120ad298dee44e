import os
import random
import re

import pytest
from pyspark.sql import functions as F

from rulemill.operators import index_store as st
from rulemill.operators import mining as mi
from rulemill.operators import model_cache as mc
from rulemill.session import shared_dir
from tests.conftest import rows

SCHEMA = "k long, v string"


def changes(spark, data):
    return spark.createDataFrame(data, "k long, v string, seq int, op string")


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_changes_rewrite_only_what_they_touch(spark):
    path, source = shared_dir(spark, "t"), spark.range(5000).select(F.col("id").alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 5).alias("v"))
    st.create_index(source, path, "k", 50)
    whole = size_of(f"{path}/data/version=0")
    held = {r["k"]: r["v"] for r in source.collect()}
    for batch, keys in enumerate(([3], [3, 4, 5, 99_999], list(range(0, 5000, 7)), [10**9])):
        part = [(k, f"new{batch}", k, "delete" if k % 5 == 0 else "upsert") for k in keys] + [(keys[0], "older", -1, "upsert")]
        touched = st.apply_changes(changes(spark, part), path, source.schema, "k", "seq", batch)
        held |= {k: f"new{batch}" for k in keys if k % 5}
        held = {k: v for k, v in held.items() if k not in keys or k % 5}
        assert len(touched) <= len(keys)
        if len(keys) < 5:
            assert size_of(f"{path}/data/version={batch + 1}") < whole * (len(touched) + 1) / 50 * 1.6
        assert rows(st.read_index(spark, path, source.schema), "k", "v") == sorted(held.items(), key=repr)
        # a batch that comes again changes nothing, and writes nothing
        before = size_of(path)
        assert st.apply_changes(changes(spark, part), path, source.schema, "k", "seq", batch) == [] and size_of(path) == before
    assert st.vacuum(spark, path) is not None
    assert rows(st.read_index(spark, path, source.schema), "k", "v") == sorted(held.items(), key=repr)


def test_a_failed_attempt_leaves_the_index_as_it_was(spark, monkeypatch):
    path, source = shared_dir(spark, "t"), spark.createDataFrame([(k, str(k)) for k in range(20)], SCHEMA)
    st.create_index(source, path, "k", 4)
    part = changes(spark, [(1, "x", 1, "upsert"), (2, None, 1, "delete")])
    with monkeypatch.context() as m:
        m.setattr(st, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            st.apply_changes(part, path, source.schema, "k", "seq", 0)
    assert rows(st.read_index(spark, path, source.schema), "k", "v") == rows(source, "k", "v")
    st.apply_changes(part, path, source.schema, "k", "seq", 0)
    assert rows(st.read_index(spark, path, source.schema), "k", "v") == sorted(((k, "x" if k == 1 else str(k)) for k in range(20) if k != 2), key=repr)


def test_empty_index_streamed_changes_and_null_keys(spark):
    path, out = shared_dir(spark, "t"), shared_dir(spark, "t")
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(ValueError):
        st.read_index(spark, path, schema)
    st.create_index(spark.createDataFrame([], schema), path, "k", 4)
    assert st.read_index(spark, path, schema).count() == 0
    for step in range(3):
        changes(spark, [(k, f"s{step}", step, "delete" if k == step else "upsert") for k in range(6)]).write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema("k long, v string, seq int, op string").parquet(f"{out}/in")
        st.sync_index(stream, path, schema, "k", "seq", f"{out}/c")
    assert rows(st.read_index(spark, path, schema), "k", "v") == [(k, "s2") for k in (0, 1, 3, 4, 5)]
    with pytest.raises(Exception, match="null key"):
        st.apply_changes(changes(spark, [(None, "x", 1, "upsert")]), path, schema, "k", "seq", 99)


def test_every_counted_text_matches_its_pattern(spark):
    rng = random.Random(6)
    parts = ["ab", "Zé", "中文", "12", "٣", "7", "-", ".", "(", "\\", " ", "\n", "²", "🙂", "^", "a1", "$"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) for _ in range(600)] + [None, "", "A9-99", "B1-234"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = mi.mine_patterns(df, "t", 10_000).collect()
    assert sum(r.n for r in got) == len(texts) - 1 and abs(sum(r.coverage for r in got) - 1) < 0.01
    for r in got[:60]:
        assert df.where(F.col("t").rlike(r.regex)).count() == r.n, r
    one = next(r for r in got if r.pattern == "A9-9")
    assert one.regex == r"^\p{L}\p{Nd}\-\p{Nd}{2,3}\z" or one.n > 2
    assert mi.mine_patterns(df.limit(0), "t", 3).count() == 0


class Counting:
    """Answers in capitals, writes down what it was asked, fails on request."""

    def __init__(self, log):
        self.log = log

    def __call__(self, texts):
        with open(self.log, "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        if len(texts) > 1 and any("bad" in t for t in texts) or texts == ["bad"]:
            raise RuntimeError("no")
        return [t.upper() for t in texts]


def test_each_text_is_asked_once_ever(spark, tmp_path):
    log, store = str(tmp_path / "log"), shared_dir(spark, "answers")
    ask = lambda texts: mc.ask_once(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").repartition(3), "t", lambda: Counting(log), store)
    first = ask(["a", "b", "a", None, "c", "a"])
    assert rows(first, "t", "response", "error") == rows(first, "t", "response", "error")  # read twice, asked once
    assert rows(first, "id", "response") == [(0, "A"), (1, "B"), (2, "A"), (3, None), (4, "C"), (5, "A")]
    assert sorted(open(log).read().split()) == ["a", "b", "c"]
    assert rows(ask(["c", "d", "c"]), "t", "response") == [("c", "C"), ("c", "C"), ("d", "D")]
    assert sorted(open(log).read().split()) == ["a", "b", "c", "d"]


def test_failures_are_told_and_asked_again(spark, tmp_path):
    log, store = str(tmp_path / "log"), shared_dir(spark, "answers")
    df = spark.createDataFrame([("bad",), ("good",), ("fine",)], "t string").coalesce(1)
    for _ in range(2):
        assert rows(mc.ask_once(df, "t", lambda: Counting(log), store), "t", "response", "error") == [
            ("bad", None, "RuntimeError: no"), ("fine", "FINE", None), ("good", "GOOD", None)]
    asked = open(log).read().split()
    assert asked.count("bad") >= 3 and asked[-1] == "bad" and "good" not in asked[-2:]


def test_batches_keep_to_the_budget():
    texts = ["x" * n for n in (10, 10, 200, 10, 10, 10)]
    parts = list(mc.budgeted(texts, 9))
    assert [t for p in parts for t in p] == texts
    assert all(len(p) == 1 or sum(len(t) // 4 + 1 for t in p) <= 9 for p in parts) and len(parts) < len(texts)
    assert re.sub("x", "", "".join(texts)) == ""
