"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point alone. A
trigram binds three of them, the first rotated by two places and the second by
one: the elementwise product. A text is bundled into the sum of its trigram
vectors, a language into the sum over its learning texts, and a text gets the
language whose bundle is nearest by cosine.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
SEED = 20_011
GAP = 0  # stands between words
KEPT_TRIGRAMS = 1 << 14  # vectors a worker keeps: 16 MB at 1,024 dimensions of one byte


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """By code point: the letter's lower-case code point, or the gap."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@functools.lru_cache(maxsize=4096)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, code])
    return (rng.integers(0, 2, dimensions, np.int8) * 2 - 1).astype(np.int8)


def trigram_codes(text: str | None) -> np.ndarray:
    """One number per trigram of a text; runs of other characters are one gap.
    Empty without a letter."""
    if not text:
        return np.zeros(0, np.int64)
    codes = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = codes[(codes != GAP) | np.concatenate([[False], codes[:-1] != GAP])]
    if not codes.any():
        return np.zeros(0, np.int64)
    codes = codes[int(codes[0] == GAP):len(codes) - int(codes[-1] == GAP)]
    wide = np.concatenate([[GAP], codes, [GAP]]).astype(np.int64)
    return wide[:-2] << 42 | wide[1:-1] << 21 | wide[2:]


class Trigrams:
    """Bound vectors of the trigrams met, by number. New ones are made when needed;
    a full table is emptied first."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.codes = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, dimensions), np.int8)

    def bind(self, codes: np.ndarray) -> np.ndarray:
        d, out = self.dimensions, np.empty((len(codes), self.dimensions), np.int8)
        for k, code in enumerate(codes.tolist()):
            a, b, c = code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF
            out[k] = np.roll(letter_vector(a, d), 2) * np.roll(letter_vector(b, d), 1) * letter_vector(c, d)
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of distinct, sorted trigrams."""
        at = np.searchsorted(self.codes, codes)
        at[at == len(self.codes)] = 0
        new = codes[self.codes[at] != codes] if len(self.codes) else codes
        if len(new):
            if len(new) > KEPT_TRIGRAMS // 2:
                return self.bind(codes)
            if len(self.codes) + len(new) > KEPT_TRIGRAMS:
                self.codes, self.vectors, new = self.codes[:0], self.vectors[:0], codes
            both = np.concatenate([self.codes, new])
            order = np.argsort(both, kind="stable")
            self.codes, self.vectors = both[order], np.concatenate([self.vectors, self.bind(new)])[order]
            at = np.searchsorted(self.codes, codes)
        return self.vectors[at]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the vectors, taken in blocks of bounded size."""
        out = np.zeros(self.dimensions, np.float64)
        for k in range(0, len(codes), 4096):
            out += counts[k:k + 4096].astype(np.float32) @ self.rows(codes[k:k + 4096]).astype(np.float32)
        return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> list[tuple[str, list[float]]]:
    """Prototype of each language: the bundle of all its texts, of unit length.

    Rows with a null text or language add nothing. Each task sums the trigrams of
    its rows by language and sends one vector for each, so what comes to the
    driver is languages x dimensions numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trigrams, sums, held = Trigrams(dimensions), {}, {}
        def settle(name):
            if name in held:
                codes, counts = np.unique(np.concatenate(held.pop(name)), return_counts=True)
                sums[name] = sums.get(name, 0) + trigrams.bundle(codes, counts)
        for pdf in batches:
            for name, body in zip(pdf["lang"], pdf["body"], strict=True):
                codes = trigram_codes(body)
                if len(codes):
                    held.setdefault(name, []).append(codes)
                    if sum(map(len, held[name][-1:])) > 1 << 20 or len(held[name]) >= 256:
                        settle(name)
        for name in [*held]:
            settle(name)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "sums": [v.tolist() for v in sums.values()]})

    source = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("body")).where("lang IS NOT NULL AND body IS NOT NULL")
    parts = source.mapInPandas(run, "lang string, sums array<double>")
    places = parts.select("lang", F.posexplode("sums").alias("place", "v")).groupBy("lang", "place").agg(F.sum("v").alias("v"))
    whole = places.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"]).alias("v"))
    out = []
    for row in whole.orderBy("lang").collect():
        v = np.array(row["v"])
        length = np.linalg.norm(v)
        out.append((row["lang"], (v / length if length else v).tolist()))
    return out


def predict(docs: DataFrame, prototypes: list[tuple[str, list[float]]], text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """Columns ``keep`` of each row with ``lang_pred`` and ``score``.

    The score is the cosine, raised to 0 where negative. A null text, one without a letter, or no
    prototype at all gives ``und`` and 0. Equal cosines go to the language first in
    order. Repeated rows are judged alike; other columns take no part.
    """
    names = [n for n, _ in prototypes]
    matrix = np.array([v for _, v in prototypes], np.float64)
    source = docs.select(*(keep or []), F.col(f"`{text}`").cast("string").alias("body"))
    kept = source.columns[:-1]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in source.dtypes[:-1]), "lang_pred string", "score double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trigrams = Trigrams(matrix.shape[1]) if names else None
        for pdf in batches:
            found, scores = [], []
            for body in pdf["body"]:
                codes = trigram_codes(body) if names else ()
                if not len(codes):
                    found.append("und")
                    scores.append(0.0)
                    continue
                v = trigrams.bundle(*np.unique(codes, return_counts=True))
                cosines = matrix @ v / (np.linalg.norm(v) or 1.0)
                best = int(np.argmax(cosines))
                found.append(names[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pdf[kept].assign(lang_pred=found, score=scores)

    return source.mapInPandas(run, schema)
