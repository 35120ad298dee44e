import hashlib
import random

import pytest

from rulemill.llm import exactdedup, queries
from tests.llm.helpers import collected, docs_of, odd_rows, prose

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(TABLE), []).append(i)
    out = []
    for text, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), k == len(ids) - 1, sha) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def sample():
    rng = random.Random(1)
    long = prose(rng, 6000)
    base = [prose(rng, n) for n in (3, 9, 9, 40, 40, 300, 2000)] + [long, long[:-1] + "X", "Y" + long[1:], long[:900] + "#" + long[901:], "ÄÖ İı ß", "äö İı ß"]
    rows = [(k, t.upper() if rng.random() < 0.3 else t) for k, t in enumerate(rng.choice(base) for _ in range(300))]
    return rows + odd_rows() + [(7, long), (None, long), (300, "a" * 5000), (301, "a" * 5000), (302, "a" * 4999 + "b")]


@pytest.mark.parametrize(("first", "growth"), [(48, 16), (1, 2), (4096, 16)])
def test_against_brute_force(spark, first, growth):
    rows = sample()
    got = exactdedup.copies(docs_of(spark, rows), first=first, growth=growth)
    assert collected(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected(rows)


def test_one_group_of_a_third_of_all_rows_and_shuffled_joins(spark):
    rows = [(k, "The same words again and again. " * 9 if k % 3 == 0 else prose(random.Random(k), 20)) for k in range(600)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = collected(exactdedup.copies(docs_of(spark, rows)), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == expected(rows)


def test_keep_one_keeps_all_columns(spark):
    rows = sample()
    docs = docs_of(spark, rows)
    out = exactdedup.keep_one(docs)
    assert out.columns == docs.columns
    kept = sorted(((r["doc_id"], (r["text"] or "").translate(TABLE)) for r in out.collect()), key=repr)
    best = {}
    for i, t in rows:
        t = (t or "").translate(TABLE)
        if t not in best or best[t] is None or i is not None and i > best[t]:
            best[t] = i
    assert kept == sorted(((i, t) for t, i in best.items()), key=repr)


def test_empty_table(spark, sf, tmp_path):
    docs_of(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op11_exact"](spark, str(tmp_path)).count() == 0
