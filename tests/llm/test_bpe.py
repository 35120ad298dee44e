"""The automaton against applying merges one by one, and against the tokenizers library."""

import array
import hashlib
import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rulemill.llm import bpe, queries
from tests.llm.helpers import docs_of, odd_rows


def by_merging(symbols, merges):
    for a, b in merges:
        k = 0
        while k + 1 < len(symbols):
            if symbols[k] == a and symbols[k + 1] == b:
                symbols[k:k + 2] = [a + b]
            k += 1
    return symbols


@pytest.mark.parametrize("seed", range(30))
@pytest.mark.parametrize("suffix", ["", "</w>"])
def test_automaton_is_the_merges(seed, suffix):
    rng = random.Random(seed)
    letters = "abc"[: rng.randint(1, 3)]
    known = list(letters) + ([c + suffix for c in letters] if suffix else [])
    merges = []
    for _ in range(rng.randint(0, 12)):
        a, b = rng.choice([k for k in known if not suffix or not k.endswith(suffix)]), rng.choice(known)
        if a + b not in known:
            known.append(a + b)
            merges.append((a, b))
    vocab = {k: n for n, k in enumerate(known)}
    machine = bpe.Automaton(vocab, merges, suffix)
    for _ in range(200):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))
        want = by_merging([*word[:-1], word[-1] + suffix], merges)
        assert [machine.labels[i] for i in machine.word(word.encode())] == want


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


def test_encoder_is_the_library(library):
    own, rng = bpe.load_encoder(queries.tokenizer_path()), random.Random(4)
    pool = "abAB019 '.\t\n\x1c\x85  éÉéΣσςİıßẞǅＡ中文\U0001f642‍#!</w>-_ͅſ²½Ⅷ٣ﬁ한"
    texts = ["", " ", "It's I'LL they'd", "x" * 3000, "<|endoftext|>Hi<|startoftext|>", "a<|endoftext|", "</w>", *(
        "".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(1500)), *(
        "".join(chr(rng.choice([rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(8)) for _ in range(500))]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert list(array.array("I", ids)) == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_improper_merges_are_refused():
    with pytest.raises(ValueError):
        bpe.Automaton({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])


def test_query_over_all_rows(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(array.array("I", want).tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows(spark, library):
    rows = odd_rows()
    out = bpe.encode(docs_of(spark, rows), queries.tokenizer_path(), "text", ["doc_id", "hash"], "ids", "decoded").collect()
    assert len(out) == len(rows)
    want = sorted(repr((i, library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted(repr((r["doc_id"], list(array.array("I", bytes(r["ids"]))))) for r in out) == want
    assert bpe.digests(docs_of(spark, []), queries.tokenizer_path()).collect() == []


def test_texts_are_held_in_slices():
    """Of a large batch only ``SLICE`` rows are encoded and decoded at once."""
    coder, rng = bpe.load_encoder(queries.tokenizer_path()), random.Random(8)
    texts = [None, "", *(f"{rng.choice(['Oak', 'élan', 'x' * 90])} {k % 300}" for k in range(2 * bpe.SLICE))]
    batch = pa.RecordBatch.from_arrays([pa.array([*range(len(texts))], pa.int32()), pa.array(texts)], ["k0", "body"])
    parts = bpe.encoded(iter([batch]), coder, True)
    first = next(parts)
    assert first.num_rows == bpe.SLICE and first.schema.names == ["k0", "ids", "decoded"]
    rows = pa.Table.from_batches([first, *parts])
    assert rows["k0"].to_pylist() == [*range(len(texts))]
    assert rows["ids"].to_pylist() == [coder.encode(t) for t in texts]
    assert rows["decoded"].to_pylist() == [coder.decode(coder.encode(t)) for t in texts]


def test_word_tables_have_a_bound(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    coder, whole = bpe.load_encoder(queries.tokenizer_path()), bpe.load_encoder(queries.tokenizer_path())
    text = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}." for k in range(600))
    assert coder.encode(text) == coder.encode(text) == b"".join(whole.encode(w) for w in text.split())
    coder.encode("a new text after the tables are full")
    assert len(coder.known) <= 50 and len(coder.words) <= 50 and len(coder.automaton.table) <= 100
