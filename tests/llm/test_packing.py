"""Best fit against a plain search; packed rows give every id back."""

import array
import hashlib
import pickle
import random

from rulemill.llm import bpe, packing, queries
from tests.llm.helpers import docs_of, odd_rows


def test_best_fit_takes_the_least_sufficient_room():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.randint(1, 40)
        sizes = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 60))), reverse=True)
        rooms = []
        for size, row in zip(sizes, packing.best_fit(sizes, capacity), strict=True):
            enough = [r for r in rooms if r >= size]
            if row == len(rooms):
                assert not enough
                rooms.append(capacity)
            else:
                assert rooms[row] == min(enough)
            rooms[row] -= size


def test_rows_are_lossless(spark, tmp_path):
    rows = odd_rows() + odd_rows()[-2:] + [(None, "another null id " * 90), (1, "the same id " * 90), (1, "the same id " * 90)]
    docs = docs_of(spark, rows).repartition(3)
    packed = packing.pack(docs, queries.tokenizer_path(), 49407, capacity=64, shard_bytes=1 << 14)
    packing.write_packed(packed, str(tmp_path / "packed"))
    whole = spark.read.parquet(str(tmp_path / "packed"))
    for r in whole.collect():
        ends = r["cu_seqlens"]
        assert len(r["ids"]) == 128 and ends[0] == 0 and ends[-1] == r["n_tokens"] <= 64 and r["resets"] == ends[:-1]
        assert ends == sorted(set(ends)) and len(r["doc_ids"]) == len(r["pieces"]) == len(ends) - 1
        assert not any(array.array("H", bytes(r["ids"]))[r["n_tokens"]:]) and len(r["doc_rows"]) == len(r["pieces"])
        assert r["ids_sha256"] == hashlib.sha256(bytes(r["ids"])).hexdigest()
    coder = bpe.load_encoder(queries.tokenizer_path())
    back = sorted(((r["doc_id"], bytes(r["ids"])) for r in packing.unpack(spark, str(tmp_path / "packed")).collect()), key=repr)
    assert back == sorted(((i, coder.encode(t) + (49407).to_bytes(4, "little")) for i, t in rows), key=repr)


def test_odd_rows(spark):
    out = packing.pack(docs_of(spark, odd_rows()), queries.tokenizer_path(), 49407).collect()
    pieces = [(i, p) for r in out for i, p in zip(r["doc_ids"], r["pieces"], strict=True)]
    assert sum(p == 0 for _, p in pieces) == len(odd_rows()) and pieces.count((5, 0)) == 2
    assert packing.pack(docs_of(spark, []), queries.tokenizer_path(), 49407).collect() == []


def test_query_places_all_tokens(spark, sf):
    rows = queries.QUERIES["op5_packed"](spark, sf).collect()
    want = queries.QUERIES["op9_bpe"](spark, sf).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(r["n_tokens"] + 1 for r in want)
    assert {i for r in rows for i in r["doc_ids"]} == {r["doc_id"] for r in want}
    assert len({(r["shard"], r["row"]) for r in rows}) == len(rows)


def test_word_tables_of_a_given_size_are_kept_by_workers():
    """A coder sent to a task starts with empty tables of its own, which hold as many words as were asked for."""
    own = bpe.load_encoder(queries.tokenizer_path(), 3)
    text = "one two three four five one two"
    ids = own.encode(text)
    sent = pickle.loads(pickle.dumps(own))
    assert not sent.known and not sent.words and len(own.known) == 3
    assert sent.encode(text) == ids and len(sent.known) == len(sent.words) == 3
