"""Exact copies by radix partitioning from the most significant byte.

A text's radix string is its length followed by its bytes. The first level deals texts
by the length and the first bytes, each later level deals what is left of a group by
the next stretch of bytes, sixteen times as long as all before. A group of one is done, and so
is a group whose bytes have all been used: its texts are equal, byte for byte, with no digest
compared. Few texts get past the first level, and a level's stretch is taken from them alone.

Groups are counted with partial counts in each task, so a group with a third of all rows is one
small row from each. Rows learn their group by a plain join of two written tables, whose
skewed partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import discard, stored

FIRST = 48  # bytes of the first level
GROWTH = 16  # times the bytes used so far that the next level has used


def lowered(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_level(rows: DataFrame, used: int, to: int) -> DataFrame:
    """One level: the groups of ``rows`` (rid, doc, body, n, g, ...) split by their bytes from
    ``used`` to ``to``. Adds size, keep and keeper, and the new ``g``: null for rows that are done,
    whose ``body`` goes too."""
    rows = rows.withColumn("digit", F.substring("body", used + 1, to - used))
    found = rows.groupBy("g", "n", "digit").agg(
        F.count("*").alias("size"), F.min("rid").alias("next"), F.max(F.struct("doc", (-F.col("rid")).alias("rid"))).alias("keep"))
    found = stored(found.where("size > 1"), "radix-groups")
    # One plan at every size: small group tables would be sent to all tasks, large ones not.
    met = rows.hint("merge").join(found.toDF("g_", "n_", "digit_", "size", "next", "keep"),
                    (F.col("g") == F.col("g_")) & (F.col("n") == F.col("n_")) & (F.col("digit") == F.col("digit_")), "left")
    goes_on = F.col("next").isNotNull() & (F.col("n") > to)
    out = met.select("rid", "doc", "sha", "n", F.when(goes_on, F.col("next")).alias("g"), F.when(goes_on, F.col("body")).alias("body"),
                     F.coalesce("size", F.lit(1)).cast("bigint").alias("size"),
                     F.when(F.col("size").isNull(), F.col("doc")).otherwise(F.col("keep.doc")).alias("keep"),
                     F.when(F.col("size").isNull(), F.col("rid")).otherwise(-F.col("keep.rid")).alias("keeper"))
    out = stored(out, "radix-level")
    discard(found)
    return out


def copies(docs: DataFrame, key: str = "doc_id", text: str = "text", first: int = FIRST, growth: int = GROWTH) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Of equal texts, A-Z lower-cased, the row with the largest id is kept; a null id is smaller than
    any other, and of repeated rows of that id the first read is kept, so each group keeps exactly one
    row. Null texts count as empty and are one group with empty ones. Texts are read whole, whatever
    their length. An empty table gives no rows; other columns are not read, so none can clash.
    """
    source = docs.select(F.col(f"`{key}`").alias("doc"), lowered(F.col(f"`{text}`")).alias("body"))
    rows = source.select(F.monotonically_increasing_id().alias("rid"), "doc", F.sha2("body", 256).alias("sha"),
                         F.octet_length("body").alias("n"), F.lit(0).cast("bigint").alias("g"), F.col("body").cast("binary").alias("body"))
    rows = active = stored(rows, "radix-rows")
    used, to, done = 0, first, []
    while True:
        level = split_level(active, used, to)
        done.append(level.where("g IS NULL").select("rid", "doc", "keep", "size", "keeper", "sha"))
        if rows is not None:
            discard(rows)
            rows = None
        active = level.where("g IS NOT NULL").select("rid", "doc", "sha", "n", "g", "body")
        if not active.head(1):
            break
        used, to = to, to * growth
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(F.col("doc").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
                      (F.col("rid") == F.col("keeper")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, without the copies: rows are told apart by id, so of rows
    alike in id and text one stays."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc, body = F.col(names[docs.columns.index(key)]), F.col(names[docs.columns.index(text)])
    gone = copies(docs, key, text).groupBy("doc_id", "text_sha256").agg(F.max(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("rows"))
    gone = stored(gone.where("kept = 0 OR rows > 1"), "radix-gone").select(F.col("doc_id").alias("d"), F.col("text_sha256").alias("h"), "kept")
    marked = plain.withColumn("doc", doc).withColumn("hash", F.sha2(lowered(body), 256))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
    whole = marked.join(gone, same, "left_anti")
    repeated = marked.join(gone.where("kept = 1"), same, "left_semi").dropDuplicates(["doc", "hash"])
    return whole.unionByName(repeated).select(*names).toDF(*docs.columns)
