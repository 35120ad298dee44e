"""Benchmark decontamination: near copies of benchmark items inside documents.

Documents and items are read as words. The CGK random walk embeds the words from
a place on: at each step it writes the word it stands on and moves on or stays,
by a random bit that depends on the step and the word. Equal stretches walk alike
and walks that an edit has parted tend to meet again, so a small edit distance
becomes a small Hamming distance. Each repetition has a walk and a sample of its
places; two stretches whose samples are equal are candidates. Items are embedded
from every word on, so an edited passage is found from any stretch of it that is
whole, and the place says where its item-sized window begins. A walk is 18 steps, some
9 words, long: an edited copy of a short item often has no whole stretch of that length.
Items of fewer than EXACT_WORDS words are therefore looked for by pieces: cut into one piece
more than edits are allowed, an item has at least one piece that no edit touches, so its
candidates are complete. Windows are verified by their exact edit distance in words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.llm.words import Vocabulary

STEPS = 18
SAMPLED = 9  # places of a walk, the first among them
REPETITIONS = 8  # of walk and sample
EXACT_WORDS = 40  # items of fewer are found by pieces, longer ones by walks
EDITS = 0.2  # edited words, of an item's words
SLICE_WORDS = 1 << 20
SEED = 4_001


class Items:
    """The benchmark's index; as large as the benchmark."""

    def __init__(self, ids: list, texts: list[str], repetitions: int = REPETITIONS, edits: float = EDITS, exact_words: int = EXACT_WORDS):
        self.ids, self.repetitions = ids, repetitions
        self.words = Vocabulary(texts)
        self.bound = [int(edits * len(w)) for w in self.words.texts]
        rng = np.random.default_rng(SEED)
        size = len(self.words.numbers) + 1
        self.moves = rng.integers(0, 2, (repetitions, STEPS, size), np.int8)
        self.samples = [np.sort(np.concatenate([[0], 1 + rng.permutation(STEPS - 1)[:SAMPLED - 1]])) for _ in range(repetitions)]
        self.keys: list[np.ndarray] = []
        self.anchors: list[np.ndarray] = []  # (item, place) by key
        gap = np.zeros(STEPS, np.int32)
        whole = np.concatenate([gap, *(x for w in self.words.texts for x in (w, gap))]).astype(np.int32)
        owner = np.concatenate([np.full(STEPS, -1), *(np.concatenate([np.full(len(w), k), np.full(STEPS, -1)]) for k, w in enumerate(self.words.texts))])
        place = np.concatenate([np.zeros(STEPS), *(np.concatenate([np.arange(len(w)), np.zeros(STEPS)]) for w in self.words.texts)])
        covered = np.zeros(len(ids), bool)
        for r in range(repetitions):
            at, key = self.walk(whole, np.flatnonzero(whole), r)
            order = np.argsort(key, kind="stable")
            self.keys.append(key[order])
            self.anchors.append(np.stack([owner[at], place[at]], 1).astype(np.int64)[order])
            covered[owner[at].astype(int)] = True
        # Pieces of the items that are short, or that no walk covers, by the pieces' length.
        cuts: dict[int, list[tuple[int, int, int]]] = {}
        for k, w in enumerate(self.words.texts):
            if len(w) and (len(w) < exact_words or not covered[k]):
                ends = [len(w) * x // (self.bound[k] + 1) for x in range(self.bound[k] + 2)]
                for low, high in zip(ends, ends[1:]):
                    if high > low:
                        cuts.setdefault(high - low, []).append((int(self.spans(w, np.array([low]), high - low)[1][0]), k, low))
        self.lengths = sorted(cuts)
        for length in self.lengths:
            rows = np.array(sorted(cuts[length]), np.int64)
            self.keys.append(rows[:, 0])
            self.anchors.append(rows[:, 1:])

    @staticmethod
    def spans(words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from which ``length`` known words follow, and the key of these."""
        at = at[at + length <= len(words)]
        key = np.zeros(len(at), np.int64)
        for step in range(length):
            seen = words[at + step]
            at, key, seen = at[seen > 0], key[seen > 0], seen[seen > 0]
            key = key * np.int64(0x100000001B3) + seen  # wraps
        return at, key

    def walk(self, words: np.ndarray, at: np.ndarray, repetition: int) -> tuple[np.ndarray, np.ndarray]:
        """Places from which a walk samples known words only, and its sample's key."""
        sample, moves = set(self.samples[repetition].tolist()), self.moves[repetition]
        here, key = at, np.zeros(len(at), np.int64)
        for step in range(max(sample) + 1):
            seen = words[np.minimum(here, len(words) - 1)]
            if step in sample:
                known = seen > 0
                at, here, key, seen = at[known], here[known], key[known], seen[known]
                key = key * np.int64(0x100000001B3) + seen  # wraps
            here = here + moves[step][seen]
        return at, key

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, start of its window) in a stretch of words."""
        found, known = [], np.flatnonzero(words)
        for r, (keys, anchors) in enumerate(zip(self.keys, self.anchors, strict=True)):
            if not len(keys):
                continue
            at, key = self.walk(words, known, r) if r < self.repetitions else self.spans(words, known, self.lengths[r - self.repetitions])
            low = np.searchsorted(keys, key)
            hit = keys[np.minimum(low, len(keys) - 1)] == key
            at, low, high = at[hit], low[hit], np.searchsorted(keys, key[hit], "right")
            n = high - low
            rows = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack([anchors[rows, 0], np.repeat(at, n) - anchors[rows, 1]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def verify(self, words: np.ndarray, item: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For windows of an item: the least edit distance of a stretch inside the
        window widened by the bound, and where that stretch begins and ends."""
        own, bound = self.words.texts[item], self.bound[item]
        n, width = len(own), len(own) + 2 * bound
        at = starts[:, None] - bound + np.arange(width)
        region = np.where((at >= 0) & (at < len(words)), words[np.clip(at, 0, len(words) - 1)], -1)
        exact = (region[:, bound:bound + n] == own).all(1)
        cost = np.where(exact, 0, n)
        first, last = np.where(exact, starts, starts), np.where(exact, starts + n, starts)
        todo = np.flatnonzero(~exact)
        shared = np.isin(region[todo], own).sum(1)
        todo = todo[shared >= n - bound]
        if len(todo):
            part = region[todo]
            line = np.zeros((len(todo), width + 1), np.int64)
            begin = np.broadcast_to(np.arange(width + 1), line.shape).copy()
            reach = np.arange(width + 1)
            for i in range(n):
                up, skip = line[:, :-1] + (part != own[i]), line[:, 1:] + 1
                step = np.concatenate([line[:, :1] + 1, np.minimum(up, skip)], 1)
                origin = np.concatenate([begin[:, :1], np.where(up <= skip, begin[:, :-1], begin[:, 1:])], 1)
                code = (step - reach) * (width + 2) + np.arange(width + 1)  # least cost, then its first place
                best = np.minimum.accumulate(code, axis=1)
                source = best % (width + 2)
                line = best // (width + 2) + reach
                begin = np.take_along_axis(origin, source, 1)
            end = np.argmin(line, axis=1)
            cost[todo] = line[np.arange(len(todo)), end]
            first[todo] = starts[todo] - bound + begin[np.arange(len(todo)), end]
            last[todo] = starts[todo] - bound + end
        return cost, first, last

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(row, item, distance, first word, words) of each near copy; of overlapping
        ones of one item the nearest, then the first."""
        parts = [self.words.read(t) if t else np.zeros(0, np.int32) for t in texts]
        gap = np.zeros(STEPS + 1 + max(self.bound, default=0), np.int32)
        begins = np.cumsum([len(gap), *(len(p) + len(gap) for p in parts)])[:-1]
        words = np.concatenate([gap, *(x for p in parts for x in (p, gap))])
        found = self.candidates(words)
        out = []
        for item in np.unique(found[:, 0]).tolist():
            starts = found[found[:, 0] == item, 1]
            cost, first, last = self.verify(words, item, starts)
            good = cost <= self.bound[item]
            near: list[tuple[int, int, int]] = []
            taken: list[tuple[int, int, int]] = sorted(zip(first[good].tolist(), last[good].tolist(), cost[good].tolist(), strict=True))
            for a, b, c in taken:
                if near and a < near[-1][1]:
                    if c < near[-1][2]:
                        near[-1] = (a, b, c)
                    continue
                near.append((a, b, c))
            for a, b, c in near:
                row = int(np.searchsorted(begins, a, "right")) - 1
                if row >= 0:
                    out.append((row, item, c, a - int(begins[row]), b - a))
        return sorted(out)


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Stretches of rows of about SLICE_WORDS words, by their length."""
    low, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t) // 6 + 32 if t else 32
        if size >= SLICE_WORDS:
            yield low, k + 1
            low, size = k + 1, 0
    if low < len(texts):
        yield low, len(texts)


def read_items(benchmark: DataFrame, key: str = "item_id", text: str = "text", edits: float = EDITS) -> Items:
    """The index of a benchmark table, which is small by nature; null and empty texts
    are passed over."""
    rows = benchmark.select(F.col(key).alias("id"), F.col(text).cast("string").alias("body")).where("body IS NOT NULL").distinct().orderBy("id", "body").collect()
    return Items([r["id"] for r in rows], [r["body"] for r in rows], edits=edits)


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", edits: float = EDITS) -> DataFrame:
    """(doc_id, item_id, distance, item_words, first_word, words) of every near copy.

    A copy is a stretch of words within ``edits`` x the item's words of edit distance,
    rounded down; so items of fewer than five words must occur exactly. All copies of
    items of fewer than EXACT_WORDS words are found; of longer ones those that a walk
    meets. Letter case of A-Z and punctuation do not count. Null and empty texts have none, very long ones are read
    whole, repeated rows are reported each, equal items as well; an empty benchmark
    finds nothing. Other columns are dropped, so none can clash.
    """
    items = read_items(benchmark, edits=edits)
    shared = docs.sparkSession.sparkContext.broadcast(items)
    source = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("body"))
    kind, item_kind = dict(source.dtypes)["doc"], dict(benchmark.dtypes)["item_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = shared.value
        for pdf in batches:
            texts = pdf["body"].tolist()
            for low, high in slices(texts):
                found = x.find(texts[low:high])
                doc = pdf["doc"].iloc[[low + f[0] for f in found]].reset_index(drop=True)
                yield pd.DataFrame({"doc_id": doc, "item_id": [x.ids[f[1]] for f in found], "distance": [f[2] for f in found],
                                    "item_words": [len(x.words.texts[f[1]]) for f in found], "first_word": [f[3] for f in found], "words": [f[4] for f in found]})

    return source.mapInPandas(run, f"doc_id {kind}, item_id {item_kind}, distance int, item_words int, first_word int, words int")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", edits: float = EDITS) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no near copy of an item."""
    shared = docs.sparkSession.sparkContext.broadcast(read_items(benchmark, edits=edits))
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain, body = docs.toDF(*names), names[docs.columns.index(text)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[body].tolist()
            bad = {low + f[0] for low, high in slices(texts) for f in shared.value.find(texts[low:high])}
            yield pdf[[k not in bad for k in range(len(pdf))]]

    return plain.mapInPandas(run, plain.schema).toDF(*docs.columns)
