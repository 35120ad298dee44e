"""Words of a text as numbers of a small vocabulary."""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np

_KEPT = bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c in _KEPT else 32 for c in range(256))
_RUN = re.compile(rb"[^ ]+")


def split_words(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters beyond ASCII,
    A-Z lower-cased; everything else separates."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def word_spans(text: str) -> list[tuple[int, int]]:
    """Places of these words, counted in characters."""
    raw = text.encode("utf-8", "surrogatepass")
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return [(int(np.searchsorted(starts, m.start())), int(np.searchsorted(starts, m.end()))) for m in _RUN.finditer(raw.translate(_TABLE))]


class Vocabulary:
    """Numbers from 1 on for the words of some short texts; 0 for all others."""

    def __init__(self, texts: list[str]):
        self.numbers: dict[bytes, int] = {}
        self.texts = [np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in split_words(t)], np.int32) for t in texts]

    def read(self, text: str) -> np.ndarray:
        words = split_words(text)
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.int32, len(words))
