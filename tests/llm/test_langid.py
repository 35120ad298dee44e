"""Held-out accuracy, and what a text without evidence gets."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from rulemill.llm import langid, queries
from tests.llm.helpers import docs_of, odd_rows


def test_held_out_accuracy(spark, sf):
    truth = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_language"](spark, sf).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held]) > 0.97


def test_bundle_is_the_sum_of_bound_vectors():
    codes = langid.trigram_codes("Ab c! ab")
    words = [(0, 97, 98), (97, 98, 0), (98, 0, 99), (0, 99, 0), (99, 0, 97), (0, 97, 98), (97, 98, 0)]
    assert sorted((c >> 42, c >> 21 & 0x1FFFFF, c & 0x1FFFFF) for c in codes.tolist()) == sorted(words)
    v = [sum(np.roll(langid.letter_vector(a, 64), 2)[k] * np.roll(langid.letter_vector(b, 64), 1)[k] * langid.letter_vector(c, 64)[k] for a, b, c in words) for k in range(64)]
    assert np.array_equal(langid.Trigrams(64).bundle(*np.unique(codes, return_counts=True)), v)


def test_table_of_vectors_may_overflow(monkeypatch):
    monkeypatch.setattr(langid, "KEPT_TRIGRAMS", 8)
    some, rng = langid.Trigrams(32), np.random.default_rng(1)
    for _ in range(40):
        codes = np.unique(rng.integers(97, 102, (rng.integers(1, 6), 3)) @ np.array([1 << 42, 1 << 21, 1]))
        assert np.array_equal(some.rows(codes), langid.Trigrams(32).bind(codes))


def test_odd_rows(spark):
    rows = odd_rows()
    docs = docs_of(spark, rows)
    models = langid.learn(docs)
    assert [n for n, _ in models] == ["en"]
    out = langid.predict(docs, models, "text", [F.col("doc_id"), F.col("score").alias("own")]).collect()
    assert len(out) == len(rows)
    und = [i for i, t in rows if not any(c.isalpha() for c in t or "")]
    assert sorted((r["doc_id"] for r in out if r["lang_pred"] == "und"), key=repr) == sorted(und, key=repr)
    assert {r["lang_pred"] for r in langid.predict(docs, [], "text", []).collect()} == {"und"}
    assert langid.learn(docs_of(spark, [])) == []
    assert langid.predict(docs_of(spark, []), models, "text", [F.col("doc_id")]).collect() == []
