"""The registered queries of the training-data operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemill.llm.common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import bpe
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import langid
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    prototypes = langid.learn(docs.where(fold(F.col("doc_id"), 4) != 2).select("text", "lang"))
    return langid.predict(docs, prototypes, "text", [F.col("doc_id"), held_out])


def toxicity_rows(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """Texts and labels of the rows that may be learnt from."""
    from rulemill.llm import toxicity
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    return toxicity.choose(docs, labels)


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs, toxicity_rows(spark, sf_dir, docs), [F.col("doc_id"), held_out])


@query
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import ann
    vectors = ann.usable(table(spark, sf_dir, "embeddings"))
    return ann.search(vectors, vectors.where("id % 20 = 0"), 20)


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import urlfilter
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.read_rules(spark, URL_RULES))


@query
def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import licenses
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op5_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import packing
    from rulemill.session import shared_dir
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 49407)
    packing.write_packed(packed, path := shared_dir(spark, "packed"))
    return spark.read.parquet(path).drop("ids", "doc_rows")


@query
def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import jaccard
    return jaccard.groups(table(spark, sf_dir, "documents"))


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import decontaminate
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import linededup
    out = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_deleted").alias("n_deleted"), F.sha2("text", 256).alias("text_sha256"))


@query
def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import exactdedup
    return exactdedup.copies(table(spark, sf_dir, "documents"))


CHECKS["op11_exact"] = """
    WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
    FROM d WINDOW w AS (PARTITION BY h)"""


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import repair
    out = repair.digests(repair.repair(repair.damage(table(spark, sf_dir, "conversations"))))
    return out.withColumnRenamed("conv", "conv_id")


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rulemill.llm import centroids
    return centroids.report(table(spark, sf_dir, "embeddings"))
