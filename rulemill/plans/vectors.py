"""Queries for embedding and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import model_cache as mc
from rulemill.operators import vectors as vc
from rulemill.plans.catalog import query
from rulemill.session import shared_dir
from rulemill.sources.tables import load

_SPARSE_SQL = """
    SELECT {id} AS doc_id, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY {id})), 6) AS weight FROM (
      SELECT {id}, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % 64 AS bucket, count(*) AS n
      FROM (SELECT {id}, unnest(regexp_extract_all(lower({text}), '([\\p{{L}}\\p{{N}}]+)', 1)) AS word FROM {table}) w
      GROUP BY 1, 2) c"""


@query(_SPARSE_SQL.format(id="doc_id", text="text", table="documents"))
def embed_docs(spark, sf_dir):
    return vc.embed_hashed(load(spark, sf_dir, "documents"), "doc_id", "text")


_TOPK_SQL = """
    SELECT query_id, vec_id, score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
        SELECT {q} AS query_id, c.vec_id,
               round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS score
        FROM {queries} q, embeddings c) s) r WHERE rank <= 10"""


@query(_TOPK_SQL.format(q="q.vec_id", queries="embeddings"))
def vector_topk(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return vc.topk(e, e, 10, "vec_id", "embedding", "vec_id", "embedding")


@query(_TOPK_SQL.format(q="q.label", queries="""(SELECT label, list(m ORDER BY pos) AS embedding FROM (
    SELECT label, pos, round(avg(x), 9) AS m FROM (
      SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) u
    GROUP BY 1, 2) a GROUP BY 1)"""))
def centroid_topk(spark, sf_dir):
    """Items nearest to the mean vector of each label."""
    e = load(spark, sf_dir, "embeddings")
    means = (e.select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))
             .groupBy("label", "pos").agg(F.round(F.avg("x"), 9).alias("m"))
             .groupBy(F.col("label").cast("bigint").alias("label"))
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("embedding")))
    return vc.topk(means, e, 10, "label", "embedding", "vec_id", "embedding")


@query()
def vector_ann(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return vc.ann_topk(e, e, 10, "vec_id", "embedding", "vec_id", "embedding", n_cells=8, n_probe=4)


_RULE_VECTORS = _SPARSE_SQL.format(id="item_id", text="text", table="benchmark")
_ASKED_VECTORS = _SPARSE_SQL.format(
    id="conv_id", text="text", table="(SELECT conv_id, arg_min(text, turn) AS text FROM conversations GROUP BY 1) q")


@query(f"""WITH r AS ({_RULE_VECTORS}), a AS ({_ASKED_VECTORS}),
                s AS (SELECT a.doc_id AS conv_id, r.doc_id AS rule_id,
                             round(sum(a.weight * r.weight) / (any_value(an.n) * any_value(rn.n)), 6) AS score
                      FROM a JOIN r ON a.bucket = r.bucket
                      JOIN (SELECT doc_id, sqrt(sum(weight * weight)) AS n FROM a GROUP BY 1) an ON an.doc_id = a.doc_id
                      JOIN (SELECT doc_id, sqrt(sum(weight * weight)) AS n FROM r GROUP BY 1) rn ON rn.doc_id = r.doc_id
                      GROUP BY 1, 2)
           SELECT conv_id, rule_id, score, rank FROM (
             SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, rule_id) AS rank FROM s) k
           WHERE rank <= 3""")
def retrieve_rules(spark, sf_dir):
    """Passages most similar to the opening of each conversation, by hashed embedding."""
    rules = load(spark, sf_dir, "benchmark").select(F.col("item_id").alias("rule_id"), F.col("text").alias("rule"))
    asked = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    hits = vc.Retriever.from_texts(rules).search_historical_rules(asked, "conv_id", "text", 3)
    return hits.select("conv_id", "rule_id", "score", "rank")


@query("""WITH t AS (SELECT DISTINCT text FROM benchmark),
               w AS (SELECT text, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}]+)', 1)) AS word FROM t),
               c AS (SELECT text, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % 64 AS bucket, count(*) AS n FROM w GROUP BY 1, 2),
               v AS (SELECT sha256(text) AS id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY text)) AS weight FROM c),
               s AS (SELECT a.id AS query_id, b.id AS text_id, round(sum(a.weight * b.weight), 6) AS score FROM v a JOIN v b USING (bucket) GROUP BY 1, 2)
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, text_id) AS rank FROM s) r WHERE rank <= 3""")
def embed_client(spark, sf_dir):
    """Passages embedded through a client, the second time from what was kept, and searched by their text ids."""
    store, texts = shared_dir(spark, "vectors"), load(spark, sf_dir, "benchmark").select(F.sha2("text", 256).alias("id"), "text")
    mc.embed(texts, "text", mc.HashingVectors, store)
    kept = mc.embed(texts, "text", mc.HashingVectors, store)
    return vc.topk(kept, kept.withColumnRenamed("id", "text_id"), 3, "id", "embedding", "text_id", "embedding")
