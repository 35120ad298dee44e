"""Kneser-Ney by hand, held-out rows, and rows without evidence."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulemill.llm import queries, toxicity
from tests.llm.helpers import docs_of, odd_rows, prose

INSULTS = ["zorgling", "plunkhead", "grubwort"]


@pytest.fixture(scope="module")
def corpus(spark):
    rng, rows, labels = random.Random(2), [], []
    for k in range(400):
        words = prose(rng, rng.randint(20, 200)).split()
        if k % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "s", "ish"]))
        rows.append((k, " ".join(words)))
        labels.append((k, None, int(k % 5 == 0)))
    return docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_expressions_and_their_forms(spark, corpus):
    docs, labels = corpus
    chosen = toxicity.choose(docs, labels.where("doc_id < 300"))
    out = {r["doc_id"]: r for r in toxicity.score(docs, chosen, [F.col("doc_id")]).collect()}
    assert len(out) == 400
    assert all(r["predicted"] == int(k % 5 == 0) == int(r["score"] >= 0.5) for k, r in out.items())
    new = docs_of(spark, [(1, prose(random.Random(5), 3000) + " zorglingly"), (2, prose(random.Random(6), 3000))])
    model_rows = toxicity.score(docs.unionByName(new.withColumn("doc_id", F.col("doc_id") + 1000)), chosen, [F.col("doc_id")])
    assert {r["doc_id"]: r["predicted"] for r in model_rows.where("doc_id > 1000").collect()} == {1001: 1, 1002: 0}


def test_model_is_kneser_ney(spark):
    rows = [(0, "abab cab"), (1, "abc abab"), (2, "bca"), (3, "cabal abba")]
    docs = docs_of(spark, rows)
    labelled = spark.createDataFrame([("abab cab", 1), ("abc abab", 0), ("bca", 0)], "body string, toxic int")
    model = toxicity.fit_model(labelled, toxicity.corpus_counts(docs), least=1)
    size = toxicity.ORDER - 1
    pad = lambda w: "^" * size + w + "$"
    grams = lambda w: [pad(w)[k - size:k + 1] for k in range(size, len(pad(w)))]
    types = {g for _, t in rows for w in t.split() for g in grams(w)}
    tails, mids, kinds = Counter(g[1:] for g in types), Counter(g[1:size] for g in types), defaultdict(set)
    for g in types:
        kinds[g[1:size]].add(g[size])
    shared = lambda g: (tails[g[1:]] - 0.75 + 0.75 * len(kinds[g[1:size]]) / 64) / mids[g[1:size]] if tails[g[1:]] else 1 / 64
    counts = {c: Counter(g for b, t in (("abab cab", 1), ("abc abab", 0), ("bca", 0)) if t == c for w in set(b.split()) for g in grams(w)) for c in (0, 1)}

    def p(c, g):
        ahead = {k: n for k, n in counts[c].items() if k[:size] == g[:size]}
        total = sum(ahead.values())
        return (max(counts[c][g] - 0.75, 0) + 0.75 * len(ahead) * shared(g)) / total if total else shared(g)

    for w in ("abab", "abc", "cab", "bca", "abba", "zz"):
        each = [math.log(p(1, g)) - math.log(p(0, g)) for g in grams(w)]
        stretch = max(sum(each[a:b]) for a in range(len(each)) for b in range(a, len(each) + 1))
        assert model.evidence([w, "a" + w])[0] == pytest.approx([stretch, sum(each), len(w) + 1], abs=1e-5), w


def test_odd_rows_and_missing_labels(spark, corpus):
    docs, labels = corpus
    rows = docs_of(spark, odd_rows())
    chosen = toxicity.choose(docs, labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (7, 0, 9)], labels.schema)))
    out = toxicity.score(rows, chosen, [F.col("doc_id"), F.col("score").alias("own")]).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    none = toxicity.choose(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(rows, none, []).collect()} == {0}
    kept = toxicity.reject(rows, chosen)
    assert kept.columns == rows.columns and kept.count() == len(odd_rows())
    assert toxicity.reject(docs, chosen).count() == 320
    assert toxicity.score(docs_of(spark, []), chosen, [F.col("doc_id")]).collect() == []


def test_query(spark, sf):
    rows = queries.QUERIES["op7_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)


def test_held_out_rows(spark, sf):
    """On all but the smallest tables: of held-out toxic rows at least 0.85 are caught, 0.8 of those caught are toxic."""
    folder = sf if "0.001" not in sf else sf.replace("0.001", "0.1")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [(labels[r["doc_id"]], r["predicted"]) for r in queries.QUERIES["op7_toxicity"](spark, folder).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    caught, missed, wrong = rows.count((1, 1)), rows.count((1, 0)), rows.count((0, 1))
    assert caught >= 0.85 * (caught + missed) and caught >= 0.8 * (caught + wrong), (caught, missed, wrong)


def test_rows_labelled_both_ways_teach_nothing(spark, corpus):
    docs, labels = corpus
    both = labels.unionByName(labels.where("doc_id < 40").withColumn("toxic", 1 - F.col("toxic")))
    kept = {r["body"] for r in toxicity.choose(docs, both).collect()}
    assert kept == {r["text"] for r in docs.where("doc_id >= 40").collect()}


def test_kept_text_is_sent_once_and_leaves_in_small_batches(spark, corpus, monkeypatch):
    docs, labels = corpus
    chosen, sent = toxicity.choose(docs, labels), []
    own = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, run, schema, *more: (sent.append(df.columns), own(df, run, schema, *more))[1])
    kept = toxicity.reject(docs.withColumn("big", F.lit(2 ** 62 + 1)).withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id"))), chosen)
    assert sent[-1] == [f"c{k}" for k in range(len(docs.columns) + 1)]
    plain = {r.doc_id for r in toxicity.score(docs, chosen, [F.col("doc_id")]).where("predicted = 0").collect()}
    got = kept.collect()
    assert {r.doc_id for r in got} == {None if i == 1 else i for i in plain} and {r.big for r in got} == {2 ** 62 + 1}
    numbers = docs.select("doc_id", F.col("doc_id").alias("text"))  # a text that is no string is cast, and left as it was
    assert dict(toxicity.reject(numbers, chosen).dtypes) == dict(numbers.dtypes)
