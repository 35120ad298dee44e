"""Deleted lines against comparing all pairs of places."""

import random

import pytest

from rulemill.llm import linededup, queries
from tests.llm.helpers import docs_of, odd_rows, prose


def by_pairs(rows, least):
    """The text of each row without the lines of runs that stand earlier."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, -1))
    own = {r: [(k, x.strip(), len(x.split())) for k, x in enumerate((r[1] or "").split("\n")) if x.strip()] for r in order}
    out = {}
    for n, row in enumerate(order):
        lines, drop = own[row], set()
        for o in range(len(lines)):
            best = 0
            for other in order[:n + 1]:
                theirs = own[other]
                for p in range(len(theirs) if other != row else o):
                    k = 0
                    while o + k < len(lines) and p + k < len(theirs) and lines[o + k][1] == theirs[p + k][1]:
                        k += 1
                    best = max(best, k)
            if sum(w for _, _, w in lines[o:o + best]) >= least:
                drop |= {k for k, _, _ in lines[o:o + best]}
        text = row[1]
        out[row] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in drop) if drop else text
    return sorted(((i, out[(i, t)]) for i, t in rows), key=repr)


def line_docs(seed):
    rng, rows = random.Random(seed), []
    lines = [prose(rng, rng.randint(1, 6)) for _ in range(12)]
    for i in range(24):
        body = [rng.choice(lines) if rng.random() < 0.8 else prose(rng, 9) for _ in range(rng.randint(0, 14))]
        if rows and rng.random() < 0.4:
            other = rng.choice(rows)[1].split("\n")
            a = rng.randrange(len(other))
            body[1:1] = other[a:a + rng.randint(1, 12)]
        if rng.random() < 0.3:
            body.insert(0, "  ")
        rows.append((i, "\n".join(body)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("least", [1, 10])
def test_runs(spark, seed, least):
    rows = line_docs(seed)
    out = linededup.dedup(docs_of(spark, rows), min_words=least).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == by_pairs(rows, least)
    for r in out:
        before = dict(rows)[r["doc_id"]]
        assert r["_lines"] == sum(bool(x.strip()) for x in before.split("\n"))
        assert r["_deleted"] == len(before.split("\n")) - len(r["text"].split("\n")) or r["_deleted"] == r["_lines"]


def test_lines_repeated_in_a_row_and_long_runs(spark):
    block = "\n".join(f"line number {k} of a long block" for k in range(70))
    rows = [(0, "x y z w\n" * 9), (1, block), (2, "head of two\n" + block + "\ntail of two"), (3, block)]
    out = linededup.dedup(docs_of(spark, rows), min_words=1).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == by_pairs(rows, 1)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = docs_of(spark, rows)
    out = linededup.dedup(docs)
    assert out.columns == [*docs.columns, "_lines", "_deleted"]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(rows, key=repr)
    shared = "this line of more than ten words stands in several documents of this test"
    more = [(None, shared), (4, shared), (4, "own\n" + shared)]
    got = sorted(((r["doc_id"], r["text"]) for r in linededup.dedup(docs_of(spark, more)).collect()), key=repr)
    assert sum(shared in t for _, t in got) == 1 and (None, "") in got
    assert linededup.dedup(docs_of(spark, [])).collect() == []


def test_short_runs_go_by_default(spark):
    hot, word = "nine words of boilerplate that many documents hold again", "menu"
    rows = [(k, f"own line {k}\n{hot}\nother line {k}\n{word}\n  {word}") for k in range(30)]
    out = linededup.dedup(docs_of(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == by_pairs(rows, 1)
    assert sum(hot in r["text"] for r in out) == sum(word in r["text"] for r in out) == 1
    assert sum(r["_deleted"] for r in out) == 29 * 3 + 1


def test_query_keeps_one_copy_of_each_line(spark, sf):
    rows = {(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lines = [x.strip() for _, t in rows for x in (t or "").split("\n") if x.strip()]
    out = linededup.dedup(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").distinct())
    assert out.groupBy().sum("_deleted").collect()[0][0] == len(lines) - len(set(lines)) > 0


def test_query(spark, sf):
    rows = queries.QUERIES["op3_line_dedup"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts) and any(r["n_deleted"] for r in rows)
    for r in rows:
        assert r["n_lines"] == sum(bool(x.strip()) for x in (texts[r["doc_id"]] or "").split("\n")) >= r["n_deleted"]
