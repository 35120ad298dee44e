"""Queries for document refinement, chunking, routing and index sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import documents as dc
from rulemill.operators import index_store as st
from rulemill.plans.catalog import query
from rulemill.session import shared_dir
from rulemill.sources.manifest import manifest_view
from rulemill.sources.tables import load
from rulemill.streaming.sync import current_index, sync_stream
from rulemill.streaming.validate import read_stream

_BLANK = r"[ \t\r\n\f\x0B]+"
_SILVER_SQL = f"""
    SELECT min(doc_id) AS doc_id, sha256(clean_text) AS content_hash, clean_text FROM (
      SELECT doc_id, trim(regexp_replace(text, '{_BLANK}', ' ', 'g')) AS clean_text FROM documents) c
    WHERE clean_text <> '' GROUP BY clean_text"""


@query("""SELECT lang, 'documents' AS ingest_source, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars
          FROM documents GROUP BY 1""")
def bronze_docs(spark, sf_dir):
    raw = dc.bronze(load(spark, sf_dir, "documents"), "documents", "2026-01-01")
    return raw.groupBy("lang", "ingest_source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("text").cast("bigint")).alias("n_chars"))


@query(f"SELECT doc_id, content_hash, length(clean_text) AS n_clean FROM ({_SILVER_SQL}) s")
def silver_docs(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return dc.silver(docs, "doc_id", "text").select("doc_id", "content_hash", F.length("clean_text").alias("n_clean"))


def _strip_sql(col):
    text = (f"regexp_replace({col}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g')")
    text = f"regexp_replace({text}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
                         ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


@query(f"""SELECT min(page_id) AS page_id, sha256(clean_text) AS content_hash, clean_text FROM (
             SELECT page_id, trim(regexp_replace({_strip_sql('html')}, '{_BLANK}', ' ', 'g')) AS clean_text FROM pages) c
           WHERE clean_text <> '' GROUP BY clean_text""")
def silver_pages(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    return dc.silver(pages, "page_id", "html", markup=True).select("page_id", "content_hash", "clean_text")


def _words_sql(relation, text, size, overlap):
    step = size - overlap
    return f"""
    SELECT doc_id, chunk_no, array_to_string(words[chunk_no * {step} + 1 : chunk_no * {step} + {size}], ' ') AS chunk_text
    FROM (SELECT doc_id, words, unnest(range(0, greatest(CAST(ceil((len(words) - {overlap}) / {float(step)}) AS BIGINT), 1)))
                 AS chunk_no
          FROM (SELECT doc_id, list_filter(string_split_regex({text}, '{_BLANK}'), lambda w: w <> '') AS words
                FROM {relation}) w WHERE len(words) > 0) c"""


@query(f"""SELECT doc_id || '-' || chunk_no AS chunk_id, doc_id, chunk_no, chunk_text
           FROM ({_words_sql('documents', 'text', 120, 20)}) t""")
def chunk_docs(spark, sf_dir):
    return dc.chunk(load(spark, sf_dir, "documents"), "doc_id", "text", 120, 20)


@query("""SELECT doc_id || '-' || chunk_no AS chunk_id, doc_id, chunk_no,
                 substr(text, CAST(chunk_no * 400 + 1 AS BIGINT), 500) AS chunk_text
          FROM (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil((length(text) - 100) / 400.0) AS BIGINT), 1)))
                       AS chunk_no FROM documents WHERE length(text) > 0) c""")
def chunk_docs_chars(spark, sf_dir):
    return dc.chunk(load(spark, sf_dir, "documents"), "doc_id", "text", 500, 100, unit="chars")


@query(f"""SELECT doc_id, chunk_no, sha256(chunk_text) AS content_hash, len(string_split(chunk_text, ' ')) AS n_words
           FROM ({_words_sql(f'({_SILVER_SQL})', 'clean_text', 200, 40)}) t""")
def gold_docs(spark, sf_dir):
    clean = dc.silver(load(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return dc.gold(clean, "doc_id", "clean_text").select("doc_id", "chunk_no", "content_hash", "n_words")


_ROUTED_SQL = """
    SELECT CASE WHEN l_partkey % 29 = 0 THEN 1 WHEN l_partkey % 3 = 0 THEN 2 WHEN l_partkey % 3 = 1 THEN 3 ELSE 4 END AS k,
           count(*) AS n FROM lineitem GROUP BY 1"""


@query(f"""SELECT rule, CAST(sum(n) AS BIGINT) AS n_rows FROM ({_ROUTED_SQL}) r JOIN (VALUES
             (1, 'product_id must match known SKUs in the ''products'' table'),
             (1, 'product_id format validation (e.g., ''CW-P-XXX'', ''CW-T-XXX'')'),
             (2, 'quantity must be a positive integer'), (2, 'quantity cannot be zero or negative'),
             (2, 'quantity cannot be null'), (3, 'estimated_arrival_date must be in the future'),
             (3, 'estimated_arrival_date must be in ISO 8601 format'),
             (4, 'general data type consistency checks')) v(k, rule) ON v.k = r.k GROUP BY 1""")
def route_rules(spark, sf_dir):
    """Query texts derived from every line item; the first matching route wins."""
    part = F.col("l_partkey")
    text = (F.when(part % 29 == 0, "schema product_id quantity; sample CW-X-999, 0")
            .when(part % 3 == 0, F.concat(F.lit("quantity of "), (part * 10).cast("string")))
            .when(part % 3 == 1, "estimated_arrival_date lies in the past")
            .otherwise("plain columns"))
    li = load(spark, sf_dir, "lineitem").select(text.alias("text"))
    return dc.route_rules(li, "text").groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT rule, count(*) AS n_rows FROM (SELECT unnest(CASE WHEN l_partkey % 13 = 0 OR contains(CAST(CASE WHEN l_partkey % 17 = 0 THEN 0
                             ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR), '0')
                        THEN ['quantity must be a positive integer', 'quantity cannot be zero or negative',
                              'quantity cannot be null']
                        ELSE ['general data type consistency checks'] END) AS rule FROM lineitem) t GROUP BY 1""")
def route_rules_manifest(spark, sf_dir):
    rows = manifest_view(spark, sf_dir).select(F.concat(
        F.lit("quantity "), F.coalesce(F.col("quantity").cast("string"), F.lit("None"))).alias("text"))
    return dc.route_rules(rows, "text").groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))


def _index(spark, sf_dir):
    """An older state of the document index: some documents not there yet, some
    with older text, some since removed from the source."""
    docs = load(spark, sf_dir, "documents")
    old = docs.where("doc_id % 5 <> 0").select(
        "doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("old "), "text")).otherwise(F.col("text")).alias("text"))
    gone = docs.where("doc_id % 11 = 0").select((-F.col("doc_id") - 1).alias("doc_id"), "text")
    return old.unionByName(gone).withColumn("content_hash", F.sha2("text", 256))


def _source(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "text").withColumn("content_hash", F.sha2("text", 256))


_PLAN_SQL = """
    SELECT doc_id, 'insert' AS action FROM documents WHERE doc_id % 5 = 0
    UNION ALL SELECT doc_id, 'update' FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 = 0
    UNION ALL SELECT -doc_id - 1, 'delete' FROM documents WHERE doc_id % 11 = 0"""


@query(_PLAN_SQL)
def sync_plan(spark, sf_dir):
    return dc.sync_plan(_source(spark, sf_dir), _index(spark, sf_dir), "doc_id")


@query("SELECT doc_id, sha256(text) AS content_hash FROM documents")
def sync_applied(spark, sf_dir):
    return dc.apply_sync(_source(spark, sf_dir), _index(spark, sf_dir), "doc_id").select("doc_id", "content_hash")


@query(f"""SELECT count(*) FILTER (WHERE action = 'insert') AS missing, count(*) FILTER (WHERE action = 'update') AS stale,
                  count(*) FILTER (WHERE action = 'delete') AS orphaned, count(*) = 0 AS ready FROM ({_PLAN_SQL}) p""")
def sync_status(spark, sf_dir):
    return dc.sync_status(_source(spark, sf_dir), _index(spark, sf_dir), "doc_id")


_CHANGES_SQL = """
    SELECT user_id AS item, event_type AS label, value AS amount, event_id AS seq,
           CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op FROM events"""


@query(f"""WITH last AS (SELECT item, arg_max(op, seq) AS op, arg_max(label, seq) AS label, arg_max(amount, seq) AS amount
                         FROM ({_CHANGES_SQL}) c GROUP BY 1)
           SELECT item, label, amount FROM last WHERE op <> 'delete' UNION ALL
           SELECT p_partkey, p_type, p_retailprice FROM part WHERE p_partkey NOT IN (SELECT item FROM last)""")
def index_upsert(spark, sf_dir):
    return dc.upsert(_part_index(spark, sf_dir), _changes(load(spark, sf_dir, "events")), "item", "seq")


def _part_index(spark, sf_dir):
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.col("p_type").alias("label"), F.col("p_retailprice").alias("amount"))


def _changes(events):
    op = F.when(F.col("event_type") == "error", "delete").otherwise("upsert")
    return events.select(F.col("user_id").alias("item"), F.col("event_type").alias("label"),
                         F.col("value").alias("amount"), F.col("event_id").alias("seq"), op.alias("op"))


@query(f"""WITH last AS (SELECT item, arg_max(op, seq) AS op, arg_max(label, seq) AS label, arg_max(amount, seq) AS amount
                         FROM ({_CHANGES_SQL}) c GROUP BY 1)
           SELECT item, label, amount FROM last WHERE op <> 'delete' UNION ALL
           SELECT p_partkey, p_type, p_retailprice FROM part WHERE p_partkey NOT IN (SELECT item FROM last)""")
def stream_sync(spark, sf_dir):
    out = shared_dir(spark, "stream-sync")
    changes = _changes(read_stream(spark, sf_dir, "events"))
    sync_stream(changes, out, "item", "seq")
    return current_index(spark, _part_index(spark, sf_dir), out, changes.schema, "item", "seq")


# The second batch changes few keys; both are applied twice.
@query("""SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN 'again' WHEN c_custkey % 7 = 0 THEN 'changed' WHEN c_custkey % 5 = 0 THEN 'added' ELSE c_mktsegment END AS segment
          FROM customer WHERE c_custkey % 11 <> 0 OR c_custkey % 97 = 0""")
def index_store(spark, sf_dir):
    customers, path = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment")), shared_dir(spark, "index-store")
    k = F.col("c_custkey")
    st.create_index(customers.where(k % 5 != 0), path, "c_custkey", 32)
    word = F.when(k % 7 == 0, "changed").otherwise("added")
    first = customers.where((k % 5 == 0) | (k % 7 == 0) | (k % 11 == 0)).select(
        k, word.alias("segment"), F.lit(1).alias("seq"), F.when(k % 11 == 0, "delete").otherwise("upsert").alias("op"))
    second = customers.where(k % 97 == 0).select(k, F.lit("again").alias("segment"), F.lit(2).alias("seq"), F.lit("upsert").alias("op"))
    for number, changes in ((0, first), (0, first), (1, second), (1, second)):
        st.apply_changes(changes, path, customers.schema, "c_custkey", "seq", number)
    return st.read_index(spark, path, customers.schema)
