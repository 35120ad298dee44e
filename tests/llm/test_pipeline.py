"""The stages together, against the operators' brute-force versions."""

import random

import pytest

import corpus_pipeline
from rulemill.llm import bpe, queries
from tests.llm.helpers import docs_of, odd_rows, prose
from tests.llm.test_decontaminate import nearest
from tests.llm.test_jaccard import by_all_pairs
from tests.llm.test_linededup import by_pairs
from rulemill.llm.words import split_words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, rows, labels = random.Random(11), [], []
    item, passage = prose(rng, 40), prose(rng, 60)
    for k in range(20, 160):
        body = "\n".join(prose(rng, rng.randint(8, 40)) for _ in range(rng.randint(1, 6)))
        if k % 7 == 0:
            body += " zorgling plunkhead zorgling"
        if k % 11 == 0:
            body += "\n" + passage
        if k % 13 == 0:
            body += "\n" + item
        if k % 17 == 0:
            body = rows[-1][1]
        if k % 19 == 0:
            words = prose(rng, 120).split()
            rows.append((k + 500, " ".join(words)))
            words[50] = "changed"
            body = " ".join(words)
        rows.append((k, body))
        labels.append((k, 1, int("zorgling" in body)))
    base = str(tmp_path_factory.mktemp("corpus"))
    docs_of(spark, [*rows, *odd_rows()]).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, [*rows, *odd_rows()], item


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_each_stage_against_brute_force(spark, folder):
    base, rows, item = folder
    docs, names = spark.read.parquet(f"{base}/documents.parquet"), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "BPE encoding and decoding"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.stored(stage(spark, docs, base), f"test-{k}")
        before = [tuple(r) for r in texts(docs)]
        if name == "toxicity":
            assert texts(out) == sorted(((i, t) for i, t in before if "zorgling" not in (t or "")), key=repr)
        elif name == "line dedup":
            after = by_pairs(before, 1)
            whole = {i: t for i, t in before}
            assert texts(out) == [(i, t) for i, t in after if (t or "").strip() or not (whole[i] or "").strip()]
            assert all(r["n_chars"] == len(r["text"]) for r in out.where("doc_id >= 20").collect())
        elif name == "n-gram Jaccard join":
            groups = by_all_pairs(before)
            assert sorted({r["doc_id"] for r in out.collect()} - {None}) == sorted({i for i, n, c in groups if i is not None and (not n or i == c)})
        elif name == "benchmark decontamination":
            own = split_words(item)
            assert texts(out) == [(i, t) for i, t in before if nearest(own, split_words(t or "")[:2000]) > 0.2 * len(own)]
        else:
            coder = bpe.load_encoder(queries.tokenizer_path())
            assert sorted(((r["doc_id"], bytes(r["ids"])) for r in out.collect()), key=repr) == sorted(((i, coder.encode(t)) for i, t in before), key=repr)
        if k < 4:
            assert out.columns == docs.columns
        docs = out
    assert sorted(r["doc_id"] for r in docs.where("doc_id IS NOT NULL").collect()) == sorted(
        r["doc_id"] for r in corpus_pipeline.run(spark, base).where("doc_id IS NOT NULL").collect())


def test_empty_tables(spark, folder):
    base, _, _ = folder
    docs = spark.read.parquet(f"{base}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, base)
        assert docs.collect() == []
