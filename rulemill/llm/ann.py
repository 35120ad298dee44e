"""Approximate nearest neighbours by balanced posting lists.

The vectors are divided into lists round centroids. Centroids are fitted on a
bounded sample by k-means that splits overfull clusters, so lists are alike in
size. A vector on the border is copied to every list whose centroid is nearly as
near as its nearest. Centroids are searched by a graph that each task holds in
memory: from a few entry points it follows neighbours while they get nearer. A
query looks through the lists whose centroid is at most ``ratio`` times as far as
its nearest. Inside the lists the score is exact.

Largest inner product becomes nearest distance by one more component, the root of
what a vector lacks to the largest length; queries have 0 there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulemill.llm.common import stored

LIST_ROWS = 256  # rows aimed at for a list
SAMPLE_ROWS = 32_768  # the centroids are fitted on at most so many vectors
MOST_LISTS = 65_536  # beyond that lists get longer and are cut into parts
COPIES = 4  # lists a vector is in, at most
BORDER = 1.1  # a list takes a vector whose nearest centroid is nearer by this factor at most
RATIO = 1.13  # a query takes lists up to this factor farther than its nearest
BUNDLE_ROWS = 16_384  # rows of near lists, or of a part of a long list, that are scored at once
NEIGHBOURS = 24  # of a centroid in the graph
PLACE_BEAM = 16  # centroids kept while a vector's lists are searched
ASK_BEAM = 64  # the same for a query; doubled until the ratio ends the search


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the vectors that take part: not null, without null, NaN or infinite
    components, not all zero, of the commonest size (the smaller, if two are), with
    an id. Others are left out; other columns are dropped, so none can clash."""
    v = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    good = good.where(finite & F.exists("v", lambda x: x != 0.0))
    sizes = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return good.where(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _kmeans(x: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Centroids of clusters alike in size: clusters above twice the mean are split
    in two, at the cost of the smallest ones."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    for step in range(12):
        owner = _nearest(x, c)
        size = np.bincount(owner, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, owner, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
        if step < 10:
            full, small = np.argsort(-size, kind="stable"), np.argsort(size, kind="stable")
            for big, low in zip(full, small, strict=True):
                if size[big] <= 2 * len(x) / len(c) or size[low] * 2 > size[big] or big == low:
                    break
                c[low] = x[rng.choice(np.flatnonzero(owner == big))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out, half = np.empty(len(x), np.int64), (c * c).sum(1) / 2
    for k in range(0, len(x), 1024):
        out[k:k + 1024] = np.argmax(x[k:k + 1024] @ c.T - half, axis=1)
    return out


def _side_by_side(c: np.ndarray) -> np.ndarray:
    """An order in which near centroids stand near: halves along the widest axis, again and again."""
    out, todo = [], [np.arange(len(c))]
    while todo:
        part = todo.pop()
        if len(part) <= 2:
            out += part.tolist()
            continue
        axis = int(np.argmax(c[part].var(0)))
        part = part[np.argsort(c[part, axis], kind="stable")]
        todo += [part[len(part) // 2:], part[:len(part) // 2]]
    return np.array(out, np.int64)


class Bundles:
    """Which lists are scored together: neighbours in number, up to BUNDLE_ROWS rows;
    a longer list stands alone in several parts. As large as the number of lists."""

    def __init__(self, sizes: np.ndarray, rows: int = BUNDLE_ROWS):
        self.of, self.parts = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
        bundle, held = 0, 0
        for k, n in enumerate(sizes.tolist()):
            if held and held + n > rows:
                bundle, held = bundle + 1, 0
            self.of[k], self.parts[k], held = bundle, max(1, -(-n // rows)), held + n

    def ask(self, lists: np.ndarray) -> list[tuple[int, int, list[int]]]:
        """(bundle, part, lists) that together hold these lists."""
        out: dict[tuple[int, int], list[int]] = {}
        for k in lists.tolist():
            for part in range(int(self.parts[k])):
                out.setdefault((int(self.of[k]), part), []).append(k)
        return [(b, p, ks) for (b, p), ks in out.items()]


class CentroidGraph:
    """Centroids, the nearest others of each, and entry points; as large as the
    number of lists, which is bounded."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        n, m = len(centroids), min(NEIGHBOURS, max(len(centroids) - 1, 0))
        self.links = np.zeros((n, m), np.int32)
        half = (centroids * centroids).sum(1) / 2
        for k in range(0, n, 1024):
            near = centroids[k:k + 1024] @ centroids.T - half
            near[np.arange(len(near)), np.arange(k, k + len(near))] = -np.inf
            if m:
                top = np.argpartition(-near, m - 1, axis=1)[:, :m] if m < n else np.argsort(-near, axis=1)[:, :m]
                self.links[k:k + 1024] = top
        step = max(1, n // 32)
        self.entries = np.arange(0, n, step)[:64]

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of up to ``beam`` centroids found near ``x``, nearest first."""
        c = self.c
        seen = np.zeros(len(c), bool)
        found = self.entries
        seen[found] = True
        far = np.sqrt(((c[found] - x) ** 2).sum(1))
        opened = np.zeros(len(c), bool)
        while True:
            order = np.argsort(far, kind="stable")[:beam]
            found, far = found[order], far[order]
            closed = found[~opened[found]][:16]
            if not len(closed):
                return found, far
            opened[closed] = True
            new = np.unique(self.links[closed])
            new = new[~seen[new]]
            seen[new] = True
            found = np.concatenate([found, new])
            far = np.concatenate([far, np.sqrt(((c[new] - x) ** 2).sum(1))])


def fit(vectors: DataFrame, list_rows: int = LIST_ROWS, sample: int = SAMPLE_ROWS) -> tuple[CentroidGraph | None, float]:
    """Graph of centroids, and the largest squared length, of (id, v) vectors. The
    sample is the ``sample`` rows first in the order of a hash of their ids."""
    stats = vectors.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("longest")).first()
    if not stats["n"]:
        return None, 0.0
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toPandas()
    x = _raised(np.stack(rows["v"].to_numpy()).astype(np.float64), stats["longest"])
    lists = int(min(max(1, round(stats["n"] / list_rows)), MOST_LISTS, max(1, len(x) // 4)))
    c = _kmeans(x, lists)
    return CentroidGraph(c[_side_by_side(c)]), float(stats["longest"])


def _raised(x: np.ndarray, longest: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0.0))[:, None]], axis=1)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, ratio: float = RATIO, border: float = BORDER, list_rows: int = LIST_ROWS) -> DataFrame:
    """The ``k`` nearest vectors found for each query, by inner product in double
    precision: query_id, rank, vec_id, score; ties go to the smaller id.

    Both inputs are (id, v) as ``usable`` gives them. A query is never its own
    candidate, by id. Equal vectors are searched as one, which stands for the
    ``k + 1`` smallest ids among them: more cannot be among the nearest, so a vector
    with very many copies is no hot list. Repeated rows count once. A query that the
    chosen lists give fewer than ``k`` looks through all lists. Without vectors or
    queries the result is empty.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors.dropDuplicates(["id"]), "ann-vectors")
    mark = Window.partitionBy("v").orderBy("id")
    few = vectors.withColumn("nth", F.row_number().over(mark)).where(F.col("nth") <= k + 1)
    alike = stored(few.groupBy("v").agg(F.min("id").alias("head"), F.array_sort(F.collect_list("id")).alias("ids")), "ann-alike")
    heads = alike.select(F.col("head").alias("id"), "v")
    graph, longest = fit(heads, list_rows)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if graph is None:
        return empty
    shared = spark.sparkContext.broadcast(graph)
    lists = len(graph.c)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = shared.value
        for pdf in batches:
            x = _raised(np.stack(pdf["v"].to_numpy()), longest)
            rows, to = [], []
            for row, one in enumerate(x):
                found, far = g.search(one, PLACE_BEAM)
                chosen = found[far <= far[0] * border + 1e-12][:COPIES]
                rows += [row] * len(chosen)
                to += chosen.tolist()
            yield pd.DataFrame({"list": to, "id": pdf["id"].to_numpy()[rows], "v": pdf["v"].to_numpy()[rows]})

    postings = stored(heads.mapInPandas(place, "list int, id long, v array<double>"), "ann-postings")
    sizes = np.zeros(lists, np.int64)
    for row in postings.groupBy("list").count().collect():
        sizes[row["list"]] = row["count"]
    bundles = spark.sparkContext.broadcast(Bundles(sizes))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = bundles.value
        for pdf in batches:
            list_, mark = pdf["list"].to_numpy(), pdf["mark"].to_numpy()
            yield pdf[["list", "id", "v"]].assign(bundle=x.of[list_], part=mark % x.parts[list_])

    cut = postings.withColumn("mark", F.pmod(F.xxhash64("id"), F.lit(1 << 40))).mapInPandas(deal, "bundle long, part long, list int, id long, v array<double>")

    def ask(everything: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            g, x = shared.value, bundles.value
            for pdf in batches:
                out = []
                for query, v in zip(pdf["id"], pdf["v"], strict=True):
                    found = np.arange(lists) if everything else _near_lists(g, np.append(v, 0.0), ratio)
                    out += [(b, p, query, v, ks) for b, p, ks in x.ask(np.sort(found))]
                yield pd.DataFrame(out, columns=["bundle", "part", "query_id", "q", "lists"])
        return run

    asked_schema = "bundle long, part long, query_id long, q array<double>, lists array<int>"
    once = queries.dropDuplicates(["id"])
    best = stored(_best(_score(once.mapInPandas(ask(False), asked_schema), cut, k), alike, k), "ann-first")
    counts = best.groupBy("query_id").count()
    short = stored(once.join(counts, once["id"] == counts["query_id"], "left").where(F.coalesce("count", F.lit(0)) < k).select("id", "v"), "ann-short")
    rest = _best(_score(short.mapInPandas(ask(True), asked_schema), cut, k), alike, k)
    whole = best.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest.select(best.columns))
    return whole.select("query_id", "rank", "vec_id", "score")


def _near_lists(graph: CentroidGraph, q: np.ndarray, ratio: float) -> np.ndarray:
    """Lists whose centroid is at most ``ratio`` times as far as the nearest one."""
    beam = ASK_BEAM
    found, far = graph.search(q, beam)
    while len(found) == beam and far[-1] <= far[0] * ratio:
        beam *= 2
        found, far = graph.search(q, beam)
    return found[far <= far[0] * ratio + 1e-12]


def _score(asked: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """The best of each query in each bundle: at most k + 1 different vectors."""

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": [], "head": [], "score": []})
        order = np.lexsort((p["id"].to_numpy(), p["list"].to_numpy()))
        ids, owner, x = p["id"].to_numpy()[order], p["list"].to_numpy()[order], np.stack(p["v"].to_numpy()[order])
        out = []
        for query, v, lists in zip(q["query_id"], q["q"], q["lists"], strict=True):
            low, high = np.searchsorted(owner, lists), np.searchsorted(owner, lists, "right")
            rows = np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])
            rows = rows[np.unique(ids[rows], return_index=True)[1]]  # copies on the border once, by id
            if not len(rows):
                continue
            near = x[rows] @ v
            if len(rows) > k + 1:
                close = near >= np.partition(near, -(k + 1))[-(k + 1)] - 1e-9 * np.abs(near).max()
                rows = rows[close]
            scores = exact(v, x[rows])
            best = np.argsort(-scores, kind="stable")[:k + 1]
            out.append((np.full(len(best), query), ids[rows[best]], scores[best]))
        columns = map(np.concatenate, zip(*out, strict=True)) if out else ([], [], [])
        return pd.DataFrame(dict(zip(("query_id", "head", "score"), columns, strict=True)))

    return asked.groupBy("bundle", "part").cogroup(postings.groupBy("bundle", "part")).applyInPandas(run, "query_id long, head long, score double")


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in one order whatever the block."""
    return np.array([float(np.add.reduce(q * row)) for row in x])


def _best(scored: DataFrame, alike: DataFrame, k: int) -> DataFrame:
    """Copies of the vectors back in place of their head; the first ``k`` of a query."""
    scored = scored.dropDuplicates(["query_id", "head"])
    pick = Window.partitionBy("query_id").orderBy(F.desc("score"), "head")
    heads = scored.withColumn("nth", F.row_number().over(pick)).where(F.col("nth") <= k + 1)
    rows = heads.join(alike.select("head", "ids"), "head").withColumn("vec_id", F.explode("ids")).where("vec_id != query_id")
    pick = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(pick)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
