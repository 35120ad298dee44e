"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import discard, stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): the smallest node it is
    connected with.

    Large-star and small-star steps in turn: each node's neighbours are hung on the
    smallest of them, first the larger ones, then the smaller ones, until nothing
    moves. Each step is one partial minimum and one join; the edges are written
    after both.
    """
    own = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(own)
    while state[0]:
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        last, own = own, stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(last)
        before, state = state, _state(own)
        if state == before:
            break
    return own.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
