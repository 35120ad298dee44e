"""Links and components against all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest

from rulemill.llm import jaccard, queries
from rulemill.llm.graph import components
from tests.llm.helpers import docs_of, odd_rows, prose


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def by_all_pairs(rows):
    """(id, size, component) of each row."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(s), low.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_copies(seed, groups=14):
    """Chains of edits, so that ends of a group are not linked themselves."""
    rng, rows = random.Random(seed), []
    common = prose(rng, 40)
    for _ in range(groups):
        text = prose(rng, rng.choice([3, 4, 5, 6, 20, 60, 150]))
        if rng.random() < 0.5:
            text = f"{text} {common}"
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            rows.append((len(rows), text))
            words = text.split()
            if rng.random() < 0.7:
                for _ in range(rng.randint(1, 2)):
                    words[rng.randrange(len(words))] = rng.choice(["zip", "ZAP", "zop"])
            text = " ".join(words)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups(spark, seed):
    rows = near_copies(seed)
    out = jaccard.groups(docs_of(spark, rows))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == by_all_pairs(rows)


def test_pivots_are_no_limit(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    monkeypatch.setattr(jaccard, "OFTEN", 2)
    rows = near_copies(7, 8)
    assert sorted((tuple(r) for r in jaccard.groups(docs_of(spark, rows)).collect()), key=repr) == by_all_pairs(rows)


def test_large_sides_are_shuffled_with_the_same_result(spark, monkeypatch):
    """Every count-checked broadcast off, Spark's own too, and few known frequencies."""
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "MOST_FREQUENT", 5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = near_copies(11, 8)
        assert sorted((tuple(r) for r in jaccard.groups(docs_of(spark, rows)).collect()), key=repr) == by_all_pairs(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_threshold_bounds_what_the_driver_gets(spark, monkeypatch):
    counts = spark.createDataFrame([(k, n) for k, n in enumerate([2] * 50 + [3] * 5 + [9000] * 3 + [9001, 20_000])], "token long, n long")
    for most in (1, 2, 4, 5, 10, 100):
        monkeypatch.setattr(jaccard, "MOST_FREQUENT", most)
        least = jaccard.threshold(counts)
        kept = counts.where(f"n >= {least}").count()
        assert kept <= most and (most not in (5, 10, 100) or kept == {5: 5, 10: 10, 100: 60}[most])
    assert jaccard.threshold(counts.limit(0)) == 1


def test_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.QUERIES["op6_jaccard"](spark, sf).collect()), key=repr) == by_all_pairs(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    assert sorted((tuple(r) for r in jaccard.groups(docs_of(spark, rows)).collect()), key=repr) == by_all_pairs(rows)
    assert jaccard.groups(docs_of(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    rows = odd_rows() + [(20, "x y z"), (21, "X y z"), (22, "x y z"), (None, "x y z")]
    docs = docs_of(spark, rows)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    want = [r for r in rows if r not in [(21, "X y z"), (22, "x y z"), (None, "x y z")]]
    want.remove((5, "a repeated row of words that is given twice over"))
    assert got == sorted(want, key=repr)
    assert jaccard.keep_one(docs_of(spark, [])).collect() == []


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 99), (99, 101), (100, 101), (7, 7), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 99: 99, 100: 99, 101: 99}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_bitmaps_lose_no_pair_that_may_link(spark):
    """Against sets of all sizes: bits that differ are never more than tokens that do."""
    rng = np.random.default_rng(5)
    for n in (1, 4, 5, 30, 400, 6000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in {0, 1, n // 10, n // 2, n}:
            other = np.concatenate([base[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)])
            bits = jaccard.bitmap(base) ^ jaccard.bitmap(other)
            assert sum(int(b).bit_count() for b in bits.view(np.uint64)) <= 2 * changed


def test_a_shared_passage_makes_few_pairs(spark, monkeypatch):
    """Texts that share much, but not enough, are told apart by bitmaps before any text is read again."""
    rng = random.Random(3)
    common = prose(rng, 200)
    rows = [(k, f"{common} {' '.join(f'w{rng.randrange(10**6)}' for _ in range(40))}") for k in range(60)]
    rows += [(100 + k, f"{rows[k][1]} end") for k in range(5)]
    read = []
    monkeypatch.setattr(jaccard, "sets_of", lambda docs, classes, orders, f=jaccard.sets_of: read.append(classes.count()) or f(docs, classes, orders))
    assert sorted((tuple(r) for r in jaccard.groups(docs_of(spark, rows)).collect()), key=repr) == by_all_pairs(rows)
    assert max(read) <= 10
