"""Calls of a model that are kept: each distinct text is asked once, ever.

Answers lie in a folder by the hash of the text. A run asks only for hashes that are not there, adds its
answers as a folder of its own, and joins them to its rows. Failures are not kept, so they are asked again next time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.session import checkpointed, discard, shared_dir

BUDGET = 8_000  # tokens of one batch, at four characters a token


class VectorClient(Protocol):
    def embed_batch(self, texts: list[str]) -> list[list[float]]: ...


def budgeted(texts: list[str], budget: int) -> Iterator[list[str]]:
    """The texts in turn, in batches of at most ``budget`` tokens; a longer text is a batch of its own."""
    held, size = [], 0
    for text in texts:
        tokens = len(text) // 4 + 1
        if held and size + tokens > budget:
            yield held
            held, size = [], 0
        held.append(text)
        size += tokens
    if held:
        yield held


def one_by_one(call: Callable[[list[str]], list[Any]], texts: list[str]) -> list[tuple[Any, str | None]]:
    """(answer, error) of each text: the batch at once, or where that fails each on its own."""
    try:
        answers = list(call(texts))
        if len(answers) == len(texts):
            return [(a, None) for a in answers]
        why = f"ValueError: {len(answers)} answers to {len(texts)} texts"
    except Exception as e:
        why = f"{type(e).__name__}: {e}"
    if len(texts) == 1:
        return [(None, why)]
    return [x for t in texts for x in one_by_one(call, [t])]


def kept_answers(spark, store: str, kind: str) -> DataFrame:
    """(hash, answer) of all runs; of a hash that two runs asked at once, one."""
    try:
        rows = spark.read.schema(f"hash string, answer {kind}").option("recursiveFileLookup", "true").parquet(store)
    except AnalysisException:  # nothing kept yet
        return spark.createDataFrame([], f"hash string, answer {kind}")
    return rows.dropDuplicates(["hash"])


def ask_once(df: DataFrame, text: str, factory: Callable[[], Callable[[list[str]], list[Any]]], store: str, kind: str = "string",
             answer: str = "response", budget: int = BUDGET) -> DataFrame:
    """Adds ``answer`` and ``error`` to each row; null texts have neither.

    ``factory`` is called once a task and gives a function from a batch of texts to their answers. Equal texts are asked once, and
    texts that ``store`` holds not at all. New answers are written before anything reads them, so however often the result is
    read and whichever executors are lost afterwards, the model is not asked again.
    """
    spark = df.sparkSession
    hashed = df.withColumn("_hash", F.sha2(F.col(text), 256))
    known = kept_answers(spark, store, kind)
    unseen = hashed.where(F.col(text).isNotNull()).groupBy("_hash").agg(F.min(text).alias("t")).join(
        known.select(F.col("hash").alias("_hash")), "_hash", "left_anti")

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = None
        for pdf in batches:
            if len(pdf) and ask is None:
                ask = factory()
            got = [x for part in budgeted(pdf["t"].tolist(), budget) for x in one_by_one(ask, part)]
            yield pd.DataFrame({"hash": pdf["_hash"], "answer": pd.Series([a for a, _ in got], index=pdf.index, dtype=object),
                                "error": pd.Series([e for _, e in got], index=pdf.index, dtype=object)})

    asked = checkpointed(unseen.mapInPandas(call, f"hash string, answer {kind}, error string"), "asked")
    good = asked.where("error IS NULL").select("hash", "answer")
    if good.head(1):
        good.write.parquet(f"{store}/{shared_dir(spark, 'run').rsplit('/', 1)[1]}")
    failed = checkpointed(asked.where("error IS NOT NULL").select(F.col("hash").alias("_hash"), "error"), "failed")
    discard(asked)
    whole = kept_answers(spark, store, kind).select(F.col("hash").alias("_hash"), F.col("answer").alias(answer))
    return hashed.join(whole, "_hash", "left").join(failed, "_hash", "left").drop("_hash")


def embed(df: DataFrame, text: str, client_factory: Callable[[], VectorClient], store: str, out: str = "embedding", budget: int = BUDGET) -> DataFrame:
    """Adds the client's vector of each text as ``out``, and ``error`` where there is none; kept like answers."""
    return ask_once(df, text, lambda: client_factory().embed_batch, store, "array<double>", out, budget)


class HashingVectors:
    """Deterministic offline client: counts of words by a hash of their letters, at unit length."""

    def __init__(self, dims: int = 64):
        self.dims = dims

    def embed_batch(self, texts: list[str]) -> list[list[float]]:
        import hashlib
        import re
        out = []
        for text in texts:
            counts = [0] * self.dims
            for word in re.findall(r"[^\W_]+", text.lower()):
                counts[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dims] += 1
            norm = sum(c * c for c in counts) ** 0.5
            out.append([c / norm if norm else 0.0 for c in counts])
        return out
