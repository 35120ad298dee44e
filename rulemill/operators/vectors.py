"""Embedding and top-k retrieval."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rulemill.functions.text import tokens

# Vectors of one side that a task holds, at least; components of them, at most; and blocks of a cell's side while these allow.
BLOCK_ROWS = 1024
BLOCK_VALUES = 1 << 22
PIECES = 16
# Scores worked on at once, and neighbouring ones of which only the best is looked at first.
SCORES, STRIDE = 1 << 21, 32
# Vectors, about so many, that the cells of the approximate search are fitted on.
TRAINED = 16_384


def embed_hashed(df: DataFrame, key: str, text: str, dims: int = 64) -> DataFrame:
    """Sparse feature-hashing embedding: rows (key, bucket, weight), unit length.

    Repeated words are counted inside the task that read the text; at most
    ``dims`` rows per text are shuffled, which also bounds the norm window.
    """
    words = df.select(key, F.explode(tokens(F.col(text))).alias("word"))
    bucket = F.pmod(F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint"), F.lit(dims))
    counts = words.groupBy(key, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    norm = F.sqrt(F.sum(F.col("n") * F.col("n")).over(W.partitionBy(key)))
    return counts.select(key, "bucket", F.round(F.col("n") / norm, 6).alias("weight"))


def densify(sparse: DataFrame, key: str, dims: int = 64) -> DataFrame:
    """Sparse rows to one array per key (``dims`` entries, so a bounded list)."""
    entries = F.map_from_entries(F.collect_list(F.struct("bucket", "weight")))
    slots = F.sequence(F.lit(0).cast("bigint"), F.lit(dims - 1).cast("bigint"))
    return sparse.groupBy(key).agg(entries.alias("_m")).select(
        key, F.transform(slots, lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0))).alias("embedding"))


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def _prepared(m: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        norms = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(norms == 0.0, 1.0, norms)
    if metric == "dot":
        return m
    raise ValueError(f"unknown metric: {metric}")


def _cells(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (cell, id, vec), all in one cell. Floats stay floats: half the bytes, and exact as doubles."""
    kind = "array<float>" if dict(df.dtypes)[vec_col] == "array<float>" else "array<double>"
    return df.where(F.col(vec_col).isNotNull()).select(
        F.lit(0).alias("cell"), F.col(id_col).alias("id"), F.col(vec_col).cast(kind).alias("vec"))


def _distance(vecs: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances up to a constant per row."""
    return (centers ** 2).sum(axis=1)[None, :] - 2 * vecs @ centers.T


def _nearest_cells(df: DataFrame, id_col: str, vec_col: str, centers: np.ndarray, n: int) -> DataFrame:
    """Rows (cell, id, vec) for the ``n`` nearest cells of each vector."""
    shared = df.sparkSession.sparkContext.broadcast(centers)
    rows = _cells(df, id_col, vec_col).select("id", "vec")

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                far = _distance(_prepared(_matrix(pdf["vec"]), "cosine"), shared.value)
                near = np.argsort(far, axis=1, kind="stable")[:, :n]
                yield pd.DataFrame({"cell": near.ravel().astype("int32"), "id": np.repeat(pdf["id"].to_numpy(), near.shape[1]),
                                    "vec": np.repeat(pdf["vec"].to_numpy(), near.shape[1])})

    return rows.mapInPandas(assign, f"cell int, id {dict(rows.dtypes)['id']}, vec {dict(rows.dtypes)['vec']}")


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one query's rounded scores, ties by place."""
    if len(scores) > k:
        near = np.nonzero(scores >= -np.partition(-scores, k - 1)[k - 1])[0]
        return near[np.argsort(-scores[near], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")


def _rounded(scores: np.ndarray) -> np.ndarray:
    return np.round(scores, 6) + 0.0


def _nearest(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, place, score) of the k best of each row of scores, rounded, ties by place.

    The k-th best of the maxima of neighbouring scores is no better than the k-th best score, so
    few scores reach it; only these are rounded and sorted.
    """
    m = scores.shape[1] // STRIDE
    if np.isnan(scores).any():
        scores = _rounded(scores)
        found = [_best(row, k) for row in scores]
        query, place = np.repeat(np.arange(len(scores)), [len(p) for p in found]), np.concatenate(found)
        return query, place, scores[query, place]
    if m > k:
        most = scores[:, :m * STRIDE].reshape(len(scores), m, STRIDE).max(axis=2)
        least = np.partition(most, m - k, axis=1)[:, m - k] - 2e-6  # equal when rounded
        query, place = np.nonzero(scores >= least[:, None])
    else:
        query, place = (x.ravel() for x in np.indices(scores.shape))
    value = _rounded(scores[query, place])
    order = np.lexsort((place, -value, query))
    query, place, value = query[order], place[order], value[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[kept], place[kept], value[kept]


def _block_rows(sizes: list[int], dims: int, block_rows: int) -> int:
    """Vectors of a block. The fullest side of a cell has ``PIECES`` blocks, so each vector is sent to a
    fixed number of tasks, until blocks would hold more than ``BLOCK_VALUES`` components."""
    return max(block_rows, min(BLOCK_VALUES // max(dims, 1), -(-max(sizes, default=0) // PIECES)))


def _search(queries: DataFrame, items: DataFrame, k: int, item_id: str, metric: str, block_rows: int) -> DataFrame:
    """Top k of (cell, id, vec) queries among the (cell, id, vec) items of the same cell: (query_id, item_id, score).

    Each cell is cut into blocks by a hash of the row, ``_block_rows`` in each, more blocks for a fuller cell,
    and each pair of blocks is one small task that gives at most k rows per query. Only row counts per cell reach the driver. Rows
    whose ids are equal are one query, or one item, with the best of their scores.
    """
    def row_counts(df):
        found = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dims")).collect()
        return {r["cell"]: r["n"] for r in found}, max((r["dims"] for r in found), default=0)

    q_type, i_type = dict(queries.dtypes)["id"], dict(items.dtypes)["id"]
    schema = f"query_id {q_type}, `{item_id}` {i_type}, score double"
    (n_q, q_dims), (n_c, c_dims) = row_counts(queries), row_counts(items)
    shared = sorted(set(n_q) & set(n_c))
    if not shared:
        return queries.sparkSession.createDataFrame([], schema)
    held = _block_rows([n[c] for n in (n_q, n_c) for c in shared], max(q_dims, c_dims), block_rows)

    def per_cell(counts):
        return F.create_map(*[F.lit(x) for c in shared for x in (c, -(-counts[c] // held))])[F.col("cell")]

    def blocked(df, mine, my_counts, other, other_counts):
        return (df.where(F.col("cell").isin(*shared))
                .withColumn(mine, F.pmod(F.xxhash64("id", "vec"), per_cell(my_counts)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), per_cell(other_counts) - 1))))

    def match(q, c):
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({"query_id": [], item_id: [], "score": []})
        own, number, copies = np.unique(c["id"].to_numpy(), return_inverse=True, return_counts=True)
        order, starts = np.argsort(number, kind="stable"), np.cumsum(copies) - copies
        vecs, asked, found = _prepared(_matrix(c["vec"])[order], metric), _prepared(_matrix(q["vec"]), metric), []
        step = min(256, max(1, SCORES // len(vecs)))
        for at in range(0, len(asked), step):
            scores = asked[at:at + step] @ vecs.T
            if len(own) < len(vecs):  # equal ids: the best of their scores
                scores = np.maximum.reduceat(scores, starts, axis=1)
            query, place, value = _nearest(scores, k)
            found.append((query + at, place, value))
        query, place, value = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({"query_id": q["id"].to_numpy()[query], item_id: own[place], "score": value})

    left, right = blocked(queries, "qb", n_q, "cb", n_c), blocked(items, "cb", n_c, "qb", n_q)
    return left.groupBy("cell", "qb", "cb").cogroup(right.groupBy("cell", "qb", "cb")).applyInPandas(match, schema)


def _ranked(found: DataFrame, item_id: str, k: int) -> DataFrame:
    best = found.groupBy("query_id", item_id).agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), item_id)
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def topk(queries: DataFrame, corpus: DataFrame, k: int, query_id: str, query_vec: str, item_id: str,
         item_vec: str, metric: str = "cosine", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Exact top-k items per query: (query_id, item_id, score, rank).

    Blocks of queries meet blocks of items in Spark, whatever the sizes, so no vector passes through the driver. Ids may be
    of any type that sorts; a query id with several vectors is asked by all of them, an item id with several is
    found by the nearest. Rows without a vector take no part.
    """
    found = _search(_cells(queries, query_id, query_vec), _cells(corpus, item_id, item_vec), k, item_id, metric, block_rows)
    return _ranked(found, item_id, k)


def ann_topk(queries: DataFrame, corpus: DataFrame, k: int, query_id: str, query_vec: str, item_id: str,
             item_vec: str, n_cells: int = 16, n_probe: int = 4, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Approximate top-k: items are compared only in the query's nearest cells.

    Cells come from k-means over some ``TRAINED`` unit vectors, chosen by a hash of the id; centres are ``n_cells`` rows. Queries go to each of
    their cells, items to one, and only these meet; a full cell is cut into blocks like any other, so it is no hot
    task. Recall rises to 1 as ``n_probe`` reaches ``n_cells``.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    vec = F.col(item_vec).cast("array<double>")
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))
    usable = corpus.where(F.col(item_vec).isNotNull())
    share = min(1.0, TRAINED / max(1, usable.count()))
    picked = usable.where(F.pmod(F.xxhash64(item_id), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    items = picked.select(array_to_vector(F.transform(vec, lambda x: F.coalesce(
        F.try_divide(x, norm), F.lit(0.0)))).alias("features")).repartition(8).persist()
    model = KMeans(k=n_cells, seed=seed, maxIter=5, initSteps=1).fit(items)
    items.unpersist()
    centers = np.array(model.clusterCenters())
    found = _search(_nearest_cells(queries, query_id, query_vec, centers, n_probe),
                    _nearest_cells(corpus, item_id, item_vec, centers, 1), k, item_id, "cosine", block_rows)
    return _ranked(found, item_id, k)


class Retriever:
    """Search of historical rules behind one object: DataFrame in, DataFrame out.

    ``rules`` holds (rule_id, rule, embedding). Query texts are embedded the
    same way and matched by exact top-k.
    """

    def __init__(self, rules: DataFrame, dims: int = 64):
        self.rules, self.dims = rules, dims

    @classmethod
    def from_texts(cls, rules: DataFrame, dims: int = 64) -> Retriever:
        """Build from (rule_id, rule) rows."""
        vectors = densify(embed_hashed(rules, "rule_id", "rule", dims), "rule_id", dims)
        return cls(rules.join(vectors, "rule_id"), dims)

    def search_historical_rules(self, queries: DataFrame, key: str, text: str, k: int = 5) -> DataFrame:
        """(key, rule_id, rule, score, rank) for each query text."""
        asked = densify(embed_hashed(queries, key, text, self.dims), key, self.dims)
        hits = topk(asked, self.rules, k, key, "embedding", "rule_id", "embedding")
        return hits.withColumnRenamed("query_id", key).join(self.rules.select("rule_id", "rule"), "rule_id")
