"""Document refinement (bronze, silver, gold), chunking, index sync."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANKS = r"[ \t\r\n\f\x0B]+"


def bronze(df: DataFrame, source_name: str, ingested_at: str) -> DataFrame:
    """Raw rows plus where and when they came in."""
    return df.withColumns({"ingest_source": F.lit(source_name), "ingested_at": F.lit(ingested_at)})


def clean_text(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, _BLANKS, " "))


def strip_markup(col: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags removed, entities decoded."""
    text = F.regexp_replace(col, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
                         ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def silver(df: DataFrame, key: str, text: str, markup: bool = False) -> DataFrame:
    """Cleaned text, empty rows dropped, one row per distinct text (lowest key).

    Copies are found on hash and key alone. Only hashes that repeat come back,
    one row each however many copies there are, so Spark can usually broadcast
    them and the texts are not shuffled at all.
    """
    raw = F.col(text)
    cleaned = (df.withColumn("clean_text", clean_text(strip_markup(raw) if markup else raw))
               .where(F.col("clean_text") != "")
               .withColumn("content_hash", F.sha2("clean_text", 256)))
    repeated = (cleaned.groupBy(F.col("content_hash").alias("_hash"))
                .agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n"))
                .where(F.col("_n") > 1).drop("_n"))
    later_copy = (F.col("content_hash") == F.col("_hash")) & (F.col(key) > F.col("_first"))
    return cleaned.join(repeated, later_copy, "left_anti")


def chunk(df: DataFrame, key: str, text: str, size: int, overlap: int, unit: str = "words") -> DataFrame:
    """Overlapping windows of ``size`` words or characters over the whole text.

    Rows (key, chunk_id, chunk_no, chunk_text); ids depend on key and position
    only. The last window is never wholly inside the one before it.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    if unit == "words":
        parts = F.filter(F.split(F.col(text), _BLANKS), lambda w: w != "")
        length = F.size("_parts")
        cut = lambda i: F.array_join(F.slice("_parts", i * step + 1, F.lit(size)), " ")
    elif unit == "chars":
        parts = F.col(text)
        length = F.char_length("_parts")
        cut = lambda i: F.substr(F.col("_parts"), i * step + 1, F.lit(size))
    else:
        raise ValueError(f"unknown unit: {unit}")
    n_chunks = F.greatest(F.ceil((length - overlap) / step), F.lit(1)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), n_chunks - 1), cut)
    return (df.select(key, parts.alias("_parts")).where(length > 0)
            .select(key, F.posexplode(windows).alias("chunk_no", "chunk_text"))
            .withColumn("chunk_id", F.concat(F.col(key).cast("string"), F.lit("-"), F.col("chunk_no").cast("string"))))


def gold(df: DataFrame, key: str, text: str, size: int = 200, overlap: int = 40) -> DataFrame:
    """Embedding-ready chunks with content hash and word count."""
    return chunk(df, key, text, size, overlap).withColumns({
        "content_hash": F.sha2("chunk_text", 256),
        "n_words": F.size(F.split("chunk_text", " ")).cast("bigint")})


# Keyword routes of the rule retrieval stub; the first match wins.
ROUTES = [
    (("product_id", "CW-X-999"), (), [
        "product_id must match known SKUs in the 'products' table",
        "product_id format validation (e.g., 'CW-P-XXX', 'CW-T-XXX')"]),
    (("quantity",), ("0", "None"), [
        "quantity must be a positive integer",
        "quantity cannot be zero or negative",
        "quantity cannot be null"]),
    (("estimated_arrival_date", "past"), (), [
        "estimated_arrival_date must be in the future",
        "estimated_arrival_date must be in ISO 8601 format"]),
]
DEFAULT_ROUTE = ["general data type consistency checks"]


def route_rules(df: DataFrame, text: str, routes=None, default=None) -> DataFrame:
    """Historical rules for a query text, one row per rule. A route needs all of
    its first words and, if it lists any, one of its second words."""
    routes, default = routes or ROUTES, default or DEFAULT_ROUTE
    picked = None
    for every, some, rules in routes:
        cond = F.lit(True)
        for w in every:
            cond = cond & F.contains(F.col(text), F.lit(w))
        if some:
            any_of = F.lit(False)
            for w in some:
                any_of = any_of | F.contains(F.col(text), F.lit(w))
            cond = cond & any_of
        value = F.array(*[F.lit(r) for r in rules])
        picked = F.when(cond, value) if picked is None else picked.when(cond, value)
    picked = picked.otherwise(F.array(*[F.lit(r) for r in default]))
    return df.select("*", F.posexplode(picked).alias("rule_no", "rule"))


def sync_plan(source: DataFrame, index: DataFrame, key: str, hash_col: str = "content_hash") -> DataFrame:
    """(key, action) with action insert, update or delete.

    Only keys and hashes are joined. Keys are unique on both sides.
    """
    s = source.select(key, F.col(hash_col).alias("_new"))
    i = index.select(key, F.col(hash_col).alias("_old"))
    action = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
              .when(F.col("_new") != F.col("_old"), "update"))
    return s.join(i, key, "full_outer").select(key, action.alias("action")).where(F.col("action").isNotNull())


def apply_sync(source: DataFrame, index: DataFrame, key: str, hash_col: str = "content_hash") -> DataFrame:
    """The index after the sync plan: equal to the source, keeping untouched rows."""
    plan = sync_plan(source, index, key, hash_col)
    changed = plan.where("action <> 'delete'").select(key)
    kept = index.join(plan.select(key), key, "left_anti")
    return kept.unionByName(source.join(changed, key, "left_semi").select(*index.columns))


def upsert(index: DataFrame, changes: DataFrame, key: str, seq: str, op: str = "op") -> DataFrame:
    """Apply upserts and deletes; the last change per key (by ``seq``) wins.

    Changes are reduced per key before the shuffle, then one full outer join
    rewrites the index.
    """
    values = [c for c in index.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(op, *values), seq).alias("_c"))
    joined = index.withColumn("_old", F.lit(True)).join(last, key, "full_outer")
    changed = F.col("_c").isNotNull()
    return (joined.where(~changed | (F.col(f"_c.{op}") != "delete"))
            .select(key, *[F.when(changed, F.col(f"_c.{v}")).otherwise(F.col(v)).alias(v) for v in values]))


def sync_status(source: DataFrame, index: DataFrame, key: str, hash_col: str = "content_hash") -> DataFrame:
    """One row: how far the index is behind its source."""
    return sync_plan(source, index, key, hash_col).agg(
        F.count_if(F.col("action") == "insert").alias("missing"),
        F.count_if(F.col("action") == "update").alias("stale"),
        F.count_if(F.col("action") == "delete").alias("orphaned"),
        (F.count(F.lit(1)) == 0).alias("ready"))
