"""Recall against all inner products; ties, copies and vectors that take no part."""

import numpy as np
import pytest

from rulemill.llm import ann, queries


def by_all(ids, x, queries_, k):
    out = {}
    for q in queries_:
        near = sorted((-float(np.add.reduce(x[ids.index(q)] * v)), i) for i, v in zip(ids, x, strict=True) if i != q)
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.0) for i, v in rows], "vec_id long, embedding array<float>, list string, score double")


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, 3000)] + 0.7 * rng.normal(size=(3000, 24))) * rng.uniform(0.5, 2, (3000, 1))
    return list(range(3000)), x.astype(np.float32).astype(float)


def test_recall_and_scores(spark, cloud):
    ids, x = cloud
    vectors = ann.usable(frame(spark, [(i, v.tolist()) for i, v in zip(ids, x, strict=True)]))
    asked = list(range(0, 3000, 20))
    got = answers(ann.search(vectors, vectors.where("id % 20 = 0"), 20, list_rows=64))
    want = by_all(ids, x, asked, 20)
    assert sorted(got) == asked and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in asked]) >= 0.9
    for q in asked:
        assert q not in dict(got[q]) and got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
        assert all(s == pytest.approx(float(x[i] @ x[q]), abs=1e-12) for i, s in got[q])


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(5)
    c = rng.normal(size=(500, 16))
    graph, hits = ann.CentroidGraph(c), 0
    for _ in range(100):
        x = rng.normal(size=16)
        far = np.sqrt(((c - x) ** 2).sum(1))
        found, d = graph.search(x, 64)
        assert np.allclose(d, far[found]) and len(set(found.tolist())) == len(found)
        hits += len(set(found[:10].tolist()) & set(np.argsort(far)[:10].tolist()))
    assert hits >= 950


def test_copies_ties_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0]) for i in range(100, 160)] + [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (40, [-1.0, 0.0])]
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows])
    vectors = ann.usable(frame(spark, [*rows, (0, [1.0, 0.0])]))
    assert answers(ann.search(vectors, vectors.where("id % 20 = 0"), 20)) == by_all(ids, x, [0, 20, 40, 100, 120, 140], 20)
    few = vectors.where("id < 50")
    assert answers(ann.search(few, few, 20)) == by_all([0, 20, 40], np.array([[1, 0], [0, 2], [-1, 0.0]]), [0, 20, 40], 20)


def test_vectors_that_take_no_part(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]),
            (None, [1.0, 1.0]), (20, [2.0, 1.0]), (9, [])]
    vectors = ann.usable(frame(spark, rows))
    assert sorted(r["id"] for r in vectors.collect()) == [1, 20]
    assert answers(ann.search(vectors, vectors.where("id = 20"))) == {20: [(1, 4.0)]}
    none = ann.usable(frame(spark, []))
    assert ann.search(none, none).collect() == []
    alone = vectors.where("id = 20")
    assert ann.search(alone, alone).collect() == []


def test_query_recall(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], float)
    got = answers(queries.QUERIES["op10_ann"](spark, sf))
    want = by_all(ids, x, [i for i in ids if i % 20 == 0], 20)
    assert sorted(got) == sorted(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]) >= 0.9
