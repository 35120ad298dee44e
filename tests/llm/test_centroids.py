import hashlib
import math
import random
from fractions import Fraction

import pytest

from rulemill.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, x int, id int"
COLS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def expected(rows, size, k=8, rounds=10):
    kept = [(i, [math.floor(Fraction(v) * 1024) for v in x], x) for i, x in rows
            if x is not None and len(x) == size and all(v is not None and math.isfinite(v) for v in x)]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centre = [v for _, v, _ in sorted(kept, key=lambda r: (digest(r[0]), r[2]))[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(centre)), key=lambda c: (far(v, centre[c]), c))
    for _ in range(rounds):
        own = [[] for _ in centre]
        for _, v, _ in kept:
            own[nearest(v)].append(v)
        centre = [[sum(p) // len(vs) for p in zip(*vs, strict=True)] if vs else c for vs, c in zip(own, centre, strict=True)]
    got = [(i, c := nearest(v), far(v, centre[c])) for i, v, _ in kept]
    fits = lambda v: v if v < 1 << 63 else None
    within = lambda c: fits(sum(d for _, x, d in got if x == c))
    whole = fits(sum(d for *_, d in got))
    out = [(i, c, fits(d), within(c), whole, hashlib.sha256(",".join(map(str, centre[c])).encode()).hexdigest()) for i, c, d in got]
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, x, 1, 2, 3, 4) for i, x in rows], SCHEMA)


def sample(size, seed=1, scale=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, scale) for _ in range(size)]) for i in range(120)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (200, [0.0] * size), (201, [-0.0] * size), (202, [1e-9] * size), (203, [-1e-9] * size)]
    rows += [(300, None), (301, []), (302, [1.0] * (size - 1)), (303, [1.0] * (size + 1)), (304, [None] + [1.0] * (size - 1))]
    return rows + [(305, [float("nan")] + [1.0] * (size - 1)), (306, [float("inf")] + [1.0] * (size - 1))]


@pytest.mark.parametrize(("size", "scale"), [(64, 1.0), (2, 0.002), (64, 1e5)])
def test_against_brute_force(spark, size, scale):
    rows = sample(size, scale=scale)
    assert told(centroids.report(frame(spark, rows), size=size)) == expected(rows, size)


def test_components_of_any_size_are_exact(spark):
    rows = sample(3) + [(400, [1e300, -1e305, 5.0]), (401, [1.7e308, 0.0, -1.7e308]), (402, [2.0 ** 45 + 0.3, 1.0, 2.0]), (403, [3e9, -3e9, 1e10])]
    assert told(centroids.report(frame(spark, rows), size=3, rounds=3)) == expected(rows, 3, rounds=3)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(9)] + [(i, [0.5, 0.0]) for i in range(20, 30)]
    assert told(centroids.report(frame(spark, rows), size=2)) == expected(rows, 2)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, n):
    rows = sample(4)[:n]
    assert told(centroids.report(frame(spark, rows), size=4)) == expected(rows, 4)


def test_query_on_given_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert told(queries.QUERIES["op13_centroids"](spark, sf)) == expected(rows, 64)
