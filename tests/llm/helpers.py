"""Small inputs with everything that real tables hold."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "the of and to in that was for river stone cloud paper window garden silver market letter winter summer candle bridge forest engine harbor".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, hash long, lines string"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", "", "a", "er", "ly"])) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, a repeated id, a very long text."""
    long = prose(random.Random(9), 30_000)
    return [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "12 34 !!"), (None, "only a null id has this text of seven words"),
            (5, "a repeated row of words that is given twice over"), (5, "a repeated row of words that is given twice over"),
            (6, "one id with a text"), (6, "and the same id with another text"), (7, long), (8, "été naïve 中文 \U0001f642 ß")]


def docs_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en" if i else None, None, len(t) if t is not None else None, 1.5, 7, "x") for i, t in rows], SCHEMA)


def collected(df: DataFrame, *cols: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
