"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

Each class has a model of a letter given the seven before it, interpolated with a
lower order that both classes share: the continuation counts of seven-letter
sequences over the whole corpus, so an expression that is rare among the labelled
rows falls back to what every document shows. A word's evidence is the largest
difference of toxic and ordinary log-likelihood over any stretch of its letters, so
endings do not hide a stem. A text has four figures over its different words: the
length-normalised difference of its log-likelihoods, the most telling word, the mean
of the three most telling ones, and the logarithm of their number, as the most telling of
many words tells less. A fifth is the largest length-normalised difference of a whole word.
Two logistic curves are fitted on labelled rows the counts have not seen: one over the first four,
as many weak signs add up, one over the fifth, as one insult among thousands of words is
enough. The larger of the two is the score.

Class counts are taken from the rows of at most ``LABELLED`` ids of a class (the
``rows`` of ``choose``); the model sent to the workers is bounded by them. As is usual for
long contexts, what ordinary rows show less than ``LEAST`` times and toxic ones never is left
out of it and counts as unseen. Corpus counts cover every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import stored

ORDER = 8
DISCOUNT = 0.75
ALPHABET = 64  # of the uniform distribution below all counts
LABELLED = 20_000  # rows of a class that counts and curve are fitted on, at most
CACHED_WORDS = 1 << 18
LEAST = 2
TELLING = 3  # words of a text, the most telling ones
FIGURES = 5  # of a text; the last has a curve of its own
SLICE = 1 << 14  # words worked on at once
START, END = "\x02", "\x03"
WORD = regex.compile(r"[\p{L}\p{M}]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def sequences(words: list[str], lower: bool = False) -> tuple[np.ndarray, ...]:
    """For each letter of each word and its end: the word's number and 64-bit keys of
    the ``ORDER`` symbols up to it and of all but the last, or, for ``lower``, of all but
    the first and of those without the last. A key is a polynomial of the symbols, so
    one symbol more is one step more."""
    text = "".join([f"{START * (ORDER - 1)}{w}{END}" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    at = np.flatnonzero(codes != ord(START))
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    short = np.zeros(len(at), np.uint64)
    for back in range(ORDER - 1 - int(lower), 0, -1):
        short = short * _STEP + codes[at - back]
    return owner, (short * _STEP + codes[at]).view(np.int64), short.view(np.int64)


def _ends(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each sequence the key of its symbols but the first and the last, and these two:
    as telling as the keys of the whole and of the tail, and shorter when shuffled."""
    text = "".join([f"{START * (ORDER - 1)}{w}{END}" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero(codes != ord(START))
    return sequences(words, lower=True)[2], codes[at - ORDER + 1].astype(np.int32), codes[at].astype(np.int32)


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def _distinct(columns: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    _, first = np.unique(columns[0], return_index=True)
    return [c[first] for c in columns]


def corpus_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Shared lower order over all rows: (mid, last, shared) with the probability of the
    last symbol after the key of those before it, of each sequence of ``ORDER - 1`` symbols, by distinct left neighbours."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[str] = set()
        for pdf in batches:
            new: set[str] = set()
            for body in pdf["body"]:
                if body:
                    new.update(body.lower().split())
            new -= seen
            if len(seen) < CACHED_WORDS:
                seen |= new
            words = list({w for c in new for w in WORD.findall(c)})
            for k in range(0, len(words), SLICE):
                part = words[k:k + SLICE]
                full, (mid, first, last) = sequences(part)[1], _ends(part)
                _, mid, first, last = _distinct((full, mid, first, last))
                yield pd.DataFrame({"mid": mid, "first": first, "last": last})

    types = docs.select(F.col(f"`{text}`").cast("string").alias("body")).mapInPandas(run, "mid bigint, first int, last int").distinct()
    tails = stored(types.groupBy("mid", "last").agg(F.count("*").alias("n")), "toxicity-tails")
    mids = tails.groupBy("mid").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    return tails.join(mids, "mid").select("mid", "last", ((F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") / ALPHABET) / F.col("total")).alias("shared"))


def class_counts(labelled: DataFrame) -> DataFrame:
    """How often a sequence stands in the different words of a row, added up over the
    rows of each class, of (body, toxic)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 64):
                own = [list(words_of(body)) for body in pdf["body"].iloc[lo:lo + 64]]
                row = np.repeat(np.arange(len(own)), [len(w) for w in own])
                words = [w for one in own for w in one]
                if not words:
                    continue
                owner, full, head = sequences(words)
                mid, _, last = _ends(words)
                toxic = pdf["toxic"].to_numpy(np.int64)[lo:lo + 64][row[owner]]
                out = pd.DataFrame({"full": full, "head": head, "mid": mid, "last": last, "t": toxic, "o": 1 - toxic})
                yield out.groupby(["full", "head", "mid", "last"], as_index=False).sum()

    rows = labelled.mapInPandas(run, "full bigint, head bigint, mid bigint, last int, t bigint, o bigint")
    return rows.groupBy("full", "head", "mid", "last").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


class Model:
    """Log-ratio of each sequence of the labelled rows, and of a new last symbol after
    each of their heads; both follow the labelled rows in size."""

    def __init__(self, full: pa.Table, heads: pa.Table):
        self.full, self.ratio = self._sorted(full)
        self.heads, self.fallback = self._sorted(heads)

    @staticmethod
    def _sorted(rows: pa.Table) -> list[np.ndarray]:
        order = np.argsort(rows.column(0).to_numpy())
        return [c.to_numpy()[order] for c in rows.columns]

    @staticmethod
    def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.float32)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, values[at]

    def ratios(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The word and the log-likelihood difference of each symbol."""
        owner, full, head = sequences(words)
        known, ratio = self._look_up(self.full, self.ratio, full)
        met, fallback = self._look_up(self.heads, self.fallback, head)
        return owner, np.where(known, ratio, np.where(met, fallback, 0.0))

    def evidence(self, words: list[str]) -> np.ndarray:
        """Columns: each word's most telling stretch, its log-likelihood difference
        and its number of symbols."""
        out = np.zeros((len(words), 3))
        for lo in range(0, len(words), SLICE):
            part = words[lo:lo + SLICE]
            owner, each = self.ratios(part)
            sizes = np.bincount(owner, minlength=len(part))
            out[lo:lo + SLICE] = np.stack([best_stretch(each, sizes), np.bincount(owner, each, len(part)), sizes], 1)
        return out


def best_stretch(each: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Largest sum over neighbours in each of the runs that ``each`` is made of, 0 at
    least. Runs are handled together by powers of two of their size."""
    out, starts = np.zeros(len(sizes)), np.cumsum(sizes) - sizes
    level = np.ceil(np.log2(sizes)).astype(int)
    for k in np.unique(level):
        runs, place = np.flatnonzero(level == k), np.arange(1 << k)
        at = np.minimum(starts[runs, None] + place, len(each) - 1)
        total = np.zeros((len(runs), (1 << k) + 1))
        np.cumsum(np.where(place < sizes[runs, None], each[at], 0.0), axis=1, out=total[:, 1:])
        out[runs] = (total - np.minimum.accumulate(total, axis=1)).max(1)
    return out


def fit_model(labelled: DataFrame, shared: DataFrame, least: int = LEAST) -> Model:
    counts = class_counts(labelled)
    counts = stored(counts, "toxicity-counts")
    heads = counts.groupBy("head").agg(
        F.sum("t").alias("ct"), F.sum("o").alias("co"), F.sum((F.col("t") > 0).cast("int")).alias("kt"), F.sum((F.col("o") > 0).cast("int")).alias("ko"))

    def share(c: str, k: str) -> Column:
        return F.when(F.col(c) > 0, DISCOUNT * F.col(k) / F.col(c)).otherwise(1.0)

    def p(n: str, c: str, k: str) -> Column:
        own = F.when(F.col(c) > 0, F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) / F.col(c)).otherwise(0.0)
        return own + share(c, k) * F.col("shared")

    full = (counts.where((F.col("t") > 0) | (F.col("o") >= least)).join(shared, ["mid", "last"], "left").withColumn("shared", F.coalesce("shared", F.lit(1.0 / ALPHABET))).join(heads, "head")
            .select("full", (F.log(p("t", "ct", "kt")) - F.log(p("o", "co", "ko"))).cast("float").alias("ratio")))
    back = heads.where((F.col("ct") > 0) | (F.col("co") >= least)).select("head", (F.log(share("ct", "kt")) - F.log(share("co", "ko"))).cast("float").alias("ratio"))
    return Model(full.toArrow(), back.toArrow())


class _Words:
    """Evidence of the words met so far, by number; forgotten when too many."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}  # texts between white space, and their words
        self.values = np.zeros((0, 3))

    def read(self, texts: list[str | None]) -> list[np.ndarray]:
        """The evidence of the different words of each text."""
        if len(self.chunks) > CACHED_WORDS:
            self.clear()
        own = [set(t.lower().split()) if t else set() for t in texts]
        numbers, met = self.numbers, len(self.numbers)
        for chunk in set().union(*own) - self.chunks.keys():
            self.chunks[chunk] = tuple([numbers.setdefault(w, len(numbers)) for w in WORD.findall(chunk)])
        new = list(islice(numbers, met, None))
        self.values = np.concatenate([self.values, self.model.evidence(new)])
        return [self.values[list(set(chain.from_iterable(map(self.chunks.__getitem__, one))))] for one in own]


def figures(words: np.ndarray) -> list[float]:
    """A text's five figures from the evidence of its different words."""
    if not len(words):
        return [0.0] * FIGURES
    best = np.sort(words[:, 0])[-TELLING:]
    return [words[:, 1].sum() / words[:, 2].sum(), best[-1], best.sum() / TELLING, math.log1p(len(words)), (words[:, 1] / words[:, 2]).max()]


def evidence(docs: DataFrame, model: Model, keep: list[Column], text: str = "text", kept: bool = False) -> DataFrame:
    """Columns ``keep`` with ``raw``: the five figures of the whole text, 0 without words. ``kept`` tells that
    the text, as a string, is one of them; then it is not sent twice. Rows leave in small batches, as they came."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep) if kept else docs.select(*keep, F.col(f"`{text}`").cast("string").alias("body"))
    width, at = len(keep), source.columns.index(text) if kept else len(keep)
    names = [*source.columns[:width], "raw"]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in source.dtypes[:width]), "raw array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                raw = pa.array([*map(figures, words.read(part.column(at).to_pylist()))], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:width], raw], names)

    return source.mapInArrow(run, schema)


def fit_curve(raw: np.ndarray, toxic: np.ndarray) -> tuple[list[float], float]:
    """Weights and offset of a logistic curve, by Newton steps with a weak prior.
    Without rows of both classes the curve is flat on the side of the rows seen."""
    if not len(raw) or toxic.min() == toxic.max():
        return [0.0] * raw.shape[1], (2.0 if len(raw) and toxic.max() > 0 else -2.0)
    mean, scale = raw.mean(0), np.where(raw.std(0) > 0, raw.std(0), 1.0)
    x = np.concatenate([(raw - mean) / scale, np.ones((len(raw), 1))], 1)
    w = np.zeros(x.shape[1])
    prior = np.diag([1e-2] * raw.shape[1] + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + prior, x.T @ (toxic - p) - prior @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    weights = w[:-1] / scale
    return weights.tolist(), float(w[-1] - weights @ mean)


def choose(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = LABELLED) -> DataFrame:
    """Labelled rows to fit on, (mark, body, toxic): of each class those of the
    ``rows`` ids first in the order of a hash, and of equal texts one. An id that is
    labelled both ways is left out. The ids are few enough to be sent to every task."""
    named = (labels.where("toxic IN (0, 1)").groupBy(F.col(key).alias("id")).agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("most"))
             .where("id IS NOT NULL AND toxic = most").drop("most"))
    order = (F.xxhash64("id"), "id")
    ids = named.where("toxic = 0").orderBy(*order).limit(rows).unionByName(named.where("toxic = 1").orderBy(*order).limit(rows))
    plain = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body")).where("body IS NOT NULL")
    met = plain.join(F.broadcast(ids), "id").withColumn("mark", F.xxhash64("body"))
    return met.groupBy("mark", "toxic").agg(F.first("body").alias("body"))


def score(docs: DataFrame, chosen: DataFrame, keep: list[Column], text: str = "text", kept: bool = False) -> DataFrame:
    """Columns ``keep`` of each row of ``docs`` with ``score`` and ``predicted``.

    ``chosen`` has the rows that ``choose`` gives. Three quarters of them are for the
    counts, the rest for the curve. A null or empty text has no evidence and its
    figures are 0; repeated rows score alike; without labels of both classes
    the curve is flat, below one half if none is toxic. Columns of ``docs`` that are not
    kept take no part; ``kept`` as in ``evidence``.
    """
    chosen = stored(chosen.withColumn("curve", F.pmod(F.shiftright("mark", 7), F.lit(4)) == 0), "toxicity-rows")
    model = fit_model(chosen.where("NOT curve").select("body", "toxic"), corpus_counts(docs, text))
    sample = evidence(chosen.where("curve"), model, [F.col("toxic")], "body").toPandas()
    raw, toxic = np.array(sample["raw"].tolist(), float).reshape(-1, FIGURES), sample["toxic"].to_numpy(float)
    together, signs = fit_curve(raw[:, :-1], toxic)
    alone, word = fit_curve(raw[:, -1:], toxic)
    out = evidence(docs, model, keep, text, kept)
    value = F.greatest(sum((F.col("raw")[k] * w for k, w in enumerate(together)), F.lit(signs)), F.col("raw")[FIGURES - 1] * max(alone[0], 0.0) + word)
    value = 1 / (1 + F.exp(-value))
    return out.withColumn("score", value).drop("raw").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def reject(docs: DataFrame, chosen: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, that are not predicted toxic."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    body = names[docs.columns.index(text)]
    judged = score(plain, chosen, [F.col(n) for n in names], body, dict(plain.dtypes)[body] == "string")
    return judged.where("predicted = 0").select(*names).toDF(*docs.columns)
