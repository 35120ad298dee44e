"""License scans: winnowed fingerprints, then banded alignment.

Runs of ``GRAM`` words of each template are hashed and winnowed: of every ``WINDOW``
runs in a row the smallest hash is kept, so a text that shares ``GRAM + WINDOW - 1``
words in a row with a template shares a fingerprint. An inverted index leads from
the runs of a document to templates and places in them; the places found give
diagonals. Round each group of near diagonals the template is aligned with
the document inside a band, and what matches is reported with its coverage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.llm.words import Vocabulary, word_spans

GRAM, WINDOW = 3, 3
BAND = 8  # words that a copy may have more or fewer than the template, at any place; of short templates a quarter of their words
COVERAGE = 0.8  # share of a template's words that must be found in order

# Public license notices.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "mit": "Released under the MIT License",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "all-rights-reserved": "All rights reserved",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
}


def winnow(hashes: np.ndarray, window: int) -> list[int]:
    """Places of the hashes kept: in each window the smallest, the rightmost if some
    are equal; the smallest of all if there are fewer than a window."""
    kept: list[int] = []
    for k in range(max(1, len(hashes) - window + 1)) if len(hashes) else ():
        part = hashes[k:k + window]
        place = k + len(part) - 1 - int(np.argmin(part[::-1]))
        if not kept or kept[-1] != place:
            kept.append(place)
    return kept


class Index:
    """The templates' fingerprints by run of words; as large as the templates."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = Vocabulary(list(templates.values()))
        self.base = len(self.words.numbers) + 1
        self.places: dict[int, list[tuple[int, int]]] = {}
        for number, words in enumerate(self.words.texts):
            runs = self.runs(words)
            mixed = runs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
            for place in dict.fromkeys(winnow(mixed, WINDOW)):
                self.places.setdefault(int(runs[place]), []).append((number, place))
        self.keys = np.array(sorted(self.places), np.int64)

    def runs(self, words: np.ndarray) -> np.ndarray:
        """A number for each run of GRAM words; one of shorter texts' all words."""
        if not len(words):
            return np.zeros(0, np.int64)
        wide = np.concatenate([words, np.zeros(max(0, GRAM - len(words)), words.dtype)]).astype(np.int64)
        out = np.zeros(len(wide) - GRAM + 1, np.int64)
        for k in range(GRAM):
            out = out * self.base + wide[k:len(wide) - GRAM + 1 + k]
        return out

    def scan(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(template, coverage, first word, word after the last) of each copy found."""
        if not len(words) or not len(self.keys):
            return []
        runs = self.runs(words)
        hit = np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, runs), len(self.keys) - 1)] == runs)
        starts: dict[int, list[int]] = {}
        for at in hit.tolist():
            for number, place in self.places[int(runs[at])]:
                starts.setdefault(number, []).append(at - place)
        found = []
        for number, own in starts.items():
            own.sort()
            band = min(BAND, len(self.words.texts[number]) // 4)
            groups = [own[:1]]
            for s in own[1:]:
                if s - groups[-1][0] <= band:
                    groups[-1].append(s)
                else:
                    groups.append([s])
            template, last = self.words.texts[number], -1
            for group in groups:
                middle = group[len(group) // 2]
                matched, first, after = align(template, words, middle, band)
                if matched and matched >= COVERAGE * len(template) and first >= last:
                    found.append((number, matched / len(template), first, after))
                    last = after
        return sorted(found, key=lambda f: (f[2], f[0]))


def align(template: np.ndarray, words: np.ndarray, start: int, band: int) -> tuple[int, int, int]:
    """Longest common subsequence of a template and the words from ``start`` on whose
    places differ by at most ``band``: its length, and the first and the place after
    the last document word in it. Of equally long ones the shortest span is taken."""
    m, width = len(template), 2 * band + 1
    nothing = (0, 0, 0, 0)  # matched, minus span, first, after
    before = [nothing] * (width + 1)
    for i in range(m):
        row = [nothing] * (width + 1)
        for d in range(width):
            j = start + i + d - band
            best = before[d + 1]  # the template's word has no partner
            if d and row[d - 1] > best:
                best = row[d - 1]
            if 0 <= j < len(words) and words[j] == template[i]:
                n, _, first, _ = before[d]
                first = first if n else j
                best = max(best, (n + 1, first - j - 1, first, j + 1))
            row[d] = best
        before = row
    n, _, first, after = max(before)
    return n, first, after


def scan(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each copy of a template: doc_id, template, coverage, first_word,
    words, start, stop (characters).

    Copies of one template do not overlap; different templates may. Null and empty
    texts have none; very long texts are scanned whole; repeated rows are reported
    each; templates without words never match. Other columns are dropped, so none
    can clash.
    """
    index = Index(TEMPLATES if templates is None else templates)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    source = docs.select(F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("body"))
    kind = dict(source.dtypes)["doc"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x = shared.value
        for pdf in batches:
            out = []
            for doc, body in zip(pdf["doc"], pdf["body"], strict=True):
                found = x.scan(x.words.read(body)) if body else []
                spans = word_spans(body) if found else []
                out += [(doc, x.names[n], c, a, b - a, spans[a][0], spans[b - 1][1]) for n, c, a, b in found]
            made = pd.DataFrame(out, columns=["doc_id", "template", "coverage", "first_word", "words", "start", "stop"])
            yield made.astype({"doc_id": pdf["doc"].dtype})

    return source.mapInPandas(run, f"doc_id {kind}, template string, coverage double, first_word int, words int, start int, stop int")
