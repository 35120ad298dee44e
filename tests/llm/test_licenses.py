"""Winnowing's guarantee, banded alignment against the whole table, and scans."""

import random

import numpy as np

from rulemill.llm import licenses, queries
from rulemill.llm.words import split_words
from tests.llm.helpers import docs_of, odd_rows, prose


def test_winnowing_keeps_one_of_each_window():
    rng = np.random.default_rng(1)
    for _ in range(200):
        hashes = rng.integers(0, 6, rng.integers(0, 20))
        kept = licenses.winnow(hashes, 3)
        assert len(kept) == len(set(kept))
        for k in range(len(hashes) - 2):
            assert any(k <= p < k + 3 and hashes[p] == min(hashes[k:k + 3]) for p in kept)
        assert bool(kept) == bool(len(hashes))


def common(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        line = [0, *(max(line[k] + 1 if x == y else 0, line[k + 1]) for k, y in enumerate(b))]
        for k in range(1, len(line)):
            line[k] = max(line[k], line[k - 1])
    return line[-1]


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(300):
        template, words = rng.integers(1, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 9))
        n, first, after = licenses.align(template, words, 0, 20)
        assert n == common(template, words)
        if n:
            assert common(template, words[first:after]) == n and 0 <= first < after <= len(words)


def test_finds_edited_notices_with_their_spans(spark):
    rng = random.Random(1)
    rows, want = [], []
    for i in range(60):
        text = prose(rng, rng.randint(0, 200))
        if i % 2:
            name = rng.choice(list(licenses.TEMPLATES))
            words = licenses.TEMPLATES[name].split()
            if len(words) > 20:
                words[10:12] = ["changed"]
                words.insert(17, "additional")
            notice = " ".join(words).upper()
            text = f"{text}\n{notice}.\n{prose(rng, 30)}"
            want.append((i, name, notice))
        rows.append((i, text))
    found = {(r["doc_id"], r["template"]): r for r in licenses.scan(docs_of(spark, rows)).collect()}
    texts = dict(rows)
    for i, name, notice in want:
        r = found[i, name]
        assert r["coverage"] >= 0.9
        assert notice.rstrip(" ).\"").startswith(texts[i][r["start"]:r["stop"]][:20]) and len(split_words(texts[i][r["start"]:r["stop"]])) == r["words"]
    assert {i for i, _ in found} == {i for i, _, _ in want}


def test_odd_rows(spark):
    rows = [*odd_rows(), (60, "All rights reserved. ALL RIGHTS RESERVED"), (None, "x all rights reserved"), (60, "all\nrights\nreserved")]
    out = licenses.scan(docs_of(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["first_word"]) for r in out) == [(0, 1), (60, 0), (60, 0), (60, 3)]
    assert licenses.scan(docs_of(spark, rows), {"none": "", "marks": "..."}).collect() == []
    assert licenses.scan(docs_of(spark, rows), {}).collect() == [] and licenses.scan(docs_of(spark, [])).collect() == []


def test_query_finds_every_notice(spark, sf):
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = b" " + b" ".join(split_words(r["text"] or "")) + b" "
        want |= {(r["doc_id"], n) for n, t in licenses.TEMPLATES.items() if b" " + b" ".join(split_words(t)) + b" " in words}
    found = queries.QUERIES["op1_license"](spark, sf).collect()
    assert {(r["doc_id"], r["template"]) for r in found if r["coverage"] == 1.0} >= want
    assert {r["doc_id"] for r in found} == {i for i, _ in want}
