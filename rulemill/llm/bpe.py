"""BPE encoding and decoding with a tokenization automaton.

The merges are applied to an automaton one after the other. It starts with one
state that every base symbol loops on. The gadget of merge ``(u, v) -> w`` splits
the state that ``u`` leads to: the copy that ``u`` now leads to has no arc ``v``,
and an arc ``w`` is laid wherever ``u`` can be read, to the state ``v`` led to.
All arcs with one label end in one state, so a state is named by its last label,
and after the last gadget exactly one path spells each word: its BPE encoding.

A copied state differs from its origin by one arc, and a laid arc repeats the
presence of another, so the automaton is held as its gadgets: when each label was
made, from which pair, and which arc each gadget took away. A transition is looked
up by following these copies back and is kept in a table from then on.
"""

from __future__ import annotations

import array
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CACHED_WORDS = 1 << 17  # entries that each of a worker's word tables takes, 25 MB; words met after that are encoded each time
SLICE = 256  # rows whose texts, ids and decoded texts a worker holds at once


def byte_symbols() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: visible Latin-1 characters stand for
    themselves, the others for the code points from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Automaton:
    """The compiled merges of one vocabulary. Its size is that of the vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        size = max(vocab.values(), default=-1) + 1
        self.labels: list[str | None] = [None] * size
        for text, i in vocab.items():
            self.labels[i] = text
        self.born, self.left, self.right = [0] * size, [-1] * size, [-1] * size
        self.cut: dict[int, int] = {}
        self.size = size
        self.table: dict[int, bool] = {}
        symbols = byte_symbols()
        products = {a + b for a, b in merges}
        self.steps: dict[int, int] = {}  # spelling read so far << 8 | next byte: spelling read then
        self.final_at: dict[int, int] = {}  # the label a spelling has at the end of a word
        self.shorter = [-1] * size  # the longest label within a word that a label's spelling starts with
        spelled: dict[int, tuple[bytes, bool]] = {}
        for text, i in vocab.items():
            if text in products:
                continue
            ends = bool(suffix) and text.endswith(suffix) and len(text) > len(suffix)
            bare = text.removesuffix(suffix) if ends else text
            if bare and all(c in symbols for c in bare):
                spelled[i] = bytes(symbols[c] for c in bare), ends
        for when, (a, b) in enumerate(merges, 1):
            if any(x in products and not self.born[vocab[x]] for x in (a, b)):
                raise ValueError("a merge must join labels made before it")
            self._gadget(when, vocab[a], vocab[b], vocab[a + b], spelled)
        self.sizes = [len(spelled[i][0]) if i in spelled else 0 for i in range(size)]
        # A spelling is numbered by the label it has within a word, if any.
        inner = {spelling: i for i, (spelling, ends) in spelled.items() if not ends}
        numbers: dict[bytes, int] = {b"": size}
        for i, (spelling, ends) in spelled.items():
            here = size
            for k in range(1, len(spelling) + 1):
                if here < size:
                    self.shorter[i] = here
                there = numbers.setdefault(spelling[:k], inner.get(spelling[:k], size + len(numbers)))
                self.steps[here << 8 | spelling[k - 1]] = there
                here = there
            if ends or not suffix:
                self.final_at[here] = i

    def _gadget(self, when: int, u: int, v: int, w: int, spelled: dict[int, tuple[bytes, bool]]) -> None:
        if self.born[w]:
            raise ValueError("two merges make one label")
        self.born[w], self.left[w], self.right[w] = when, u, v
        # Where v cannot follow u any more, the merge never applies and w has no arc.
        if u in spelled and v in spelled and self._resolve(u, v, when - 1):
            self.cut[u * self.size + v] = when
            spelled[w] = spelled[u][0] + spelled[v][0], spelled[v][1]

    def follows(self, last: int, label: int) -> bool:
        """Is there an arc ``label`` in the state that ``last`` leads to?"""
        key = last * self.size + label
        known = self.table.get(key)
        if known is None:
            known = self.table[key] = self._resolve(last, label, self.size)
        return known

    def _resolve(self, last: int, label: int, now: int) -> bool:
        """The same after the first ``now`` gadgets, for labels made by then."""
        born = self.born
        while True:
            if self.cut.get(last * self.size + label, now + 1) <= now:
                return False
            if born[last] > born[label]:  # the state was copied from the one its right part led to
                now, last = born[last] - 1, self.right[last]
            elif born[label]:  # the arc was laid where its left part could be read
                now, label = born[label], self.left[label]
            else:
                return True

    def word(self, spelling: bytes) -> list[int]:
        """Labels on the only path that spells a word, trying long labels first.

        Only one path reaches each position, so a position from which no label
        leads on is never entered again: the work is linear in the length."""
        n, size, known, read, sizes, shorter = len(spelling), self.size, self.table.get, self.steps.get, self.sizes, self.shorter
        path: list[int] = []
        dead: set[int] = set()
        at, before = 0, -1
        while at < n:
            here, label = size, -1
            for byte in spelling[at:-1]:
                here = read(here << 8 | byte)
                if here is None:
                    break
                if here < size:
                    label = here
            else:
                label = self.final_at.get(read(here << 8 | spelling[-1]), label)
            while True:
                while label >= 0:
                    if not dead or at + sizes[label] not in dead:
                        go = before < 0 or known(before * size + label)
                        if go is None:
                            go = self.follows(before, label)
                        if go:
                            break
                    label = shorter[label]
                else:
                    if not path:
                        raise ValueError("the vocabulary lacks a byte of this word")
                    dead.add(at)
                    last = path.pop()
                    at, before, label = at - sizes[last], path[-1] if path else -1, shorter[last]
                    continue
                break
            path.append(label)
            at, before = at + sizes[label], label
        return path


class _Table(dict):
    """Values by text, made where missing; up to ``most`` of short texts are kept."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most

    def __missing__(self, text: str) -> bytes:
        value = self.make(text)
        if len(self) < self.most and len(text) <= 64:
            self[text] = value
        return value


class Encoder:
    """Texts to ids and back, by a tokenizer file of word-end BPE: canonical
    composition, lower case, white space dropped, words split by a pattern."""

    def __init__(self, spec: dict, cached: int | None = None):
        self.cached = cached or CACHED_WORDS
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("unk_token") or model.get("byte_fallback"):
            raise ValueError("only plain BPE models are supported")
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError("unsupported normalizer or decoder")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.labels = list(self.automaton.labels)
        self.pattern = regex.compile(split["pattern"]["Regex"])
        small = {"type": "WordLevel", "vocab": {"": 0}, "unk_token": ""}
        self.splitter = json.dumps({"version": "1.0", "normalizer": spec["normalizer"], "pre_tokenizer": {
            **spec["pre_tokenizer"], "pretokenizers": [split]}, "model": small})
        self.added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        for text, i in self.added.items():
            self.labels += [None] * (i + 1 - len(self.labels))
            self.labels[i] = text
        self.markers = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.start_anew()

    def start_anew(self) -> None:
        self.known, self.words = _Table(self._chunk, self.cached), _Table(self._word, self.cached)
        self.rare = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "words", "rare")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.start_anew()

    def _pieces(self, chunk: str) -> list[str]:
        """Words of a text without the white space that separates words."""
        if chunk.isascii():
            return self.pattern.findall(chunk.lower())
        if max(chunk) < "\u0250":
            return self.pattern.findall(unicodedata.normalize("NFC", chunk).lower())
        # Further on, letters and digits depend on the Unicode version: ask the library that splits.
        split = Tokenizer.from_str(self.splitter) if self.rare is None else self.rare
        self.rare = split
        clean = split.normalizer.normalize_str(chunk)
        return [clean[a:b] for _, (a, b) in split.pre_tokenizer.pre_tokenize_str(clean)]

    def _word(self, piece: str) -> bytes:
        path = array.array("I", self.automaton.word(piece.encode()))
        if sys.byteorder == "big":
            path.byteswap()
        return path.tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """Ids of such a text, as little-endian 32-bit integers."""
        return b"".join(map(self.words.__getitem__, self._pieces(chunk)))

    def _plain(self, text: str) -> bytes:
        # str.split() also splits at four control characters that are no white space here
        chunks = regex.split(r"\s+", text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        out = b"".join(map(self.known.__getitem__, chunks))
        if len(self.automaton.table) > 2 * self.cached:
            self.automaton.table.clear()
        return out

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text; none for a null one."""
        if not text:
            return b""
        if self.markers is None or not self.markers.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.markers.finditer(text):
            out += [self._plain(text[at:m.start()]), self.added[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs taken, with a blank between; ids without a label
        are passed over."""
        numbers = array.array("I", ids)
        if sys.byteorder == "big":
            numbers.byteswap()
        labels = self.labels
        try:
            return " ".join([labels[i] for i in numbers])
        except (IndexError, TypeError):
            return " ".join(labels[i] for i in numbers if i < len(labels) and labels[i] is not None)


def load_encoder(path: str, cached: int | None = None) -> Encoder:
    """Compile a tokenizer file, read on the driver; its size is the vocabulary's."""
    with open(path, encoding="utf-8") as f:
        return Encoder(json.load(f), cached)


def encoded(batches: Iterator[pa.RecordBatch], coder: Encoder, decoded: bool) -> Iterator[pa.RecordBatch]:
    """Batches with their last column, the texts, replaced by ids and, if asked for, decoded
    texts; ``SLICE`` rows at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, SLICE):
            part = batch.slice(lo, SLICE)
            ids = [coder.encode(t) for t in part.columns[-1].to_pylist()]
            texts = [pa.array(map(coder.decode, ids), pa.string())] if decoded else []
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(ids, pa.binary()), *texts], [*part.schema.names[:-1], "ids", *["decoded"] * decoded])


def encode(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None,
           ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Columns ``keep`` of each row with its ids (binary, little-endian 32-bit) and,
    if named, the text decoded from them.

    A null or empty text has no ids and decodes to the empty text; repeated rows are
    encoded each; other columns of ``docs`` are dropped, so none can clash. Any
    length is encoded whole: memory follows the longest texts of ``SLICE`` rows.
    """
    spark = docs.sparkSession
    keep = list(keep if keep is not None else [c for c in docs.columns if c != text])
    shared = spark.sparkContext.broadcast(load_encoder(tokenizer))
    names = [f"k{k}" for k in range(len(keep))]
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").cast("string").alias("body"))
    kinds = dict(source.dtypes)
    schema = ", ".join([*(f"{n} {kinds[n]}" for n in names), "ids binary", *(["decoded string"] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, shared.value, bool(decoded))

    return source.mapInArrow(run, schema).toDF(*keep, ids, *([decoded] if decoded else []))


def digests(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the decoded text, of each row."""
    out = encode(docs, tokenizer, text, [key], "ids", "decoded")
    return out.select(key, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
