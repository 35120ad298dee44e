"""Token ids in packed rows: best-fit-decreasing packing.

Texts are encoded, closed with an end id and cut into pieces of at most one row's
capacity, so nothing is lost. Pieces are dealt out evenly to shards of a bounded
number of bytes, and each shard is packed alone: the longest piece first, each into the
row with the least room that still holds it. Rows with the same room hang on one
leaf of a segment tree over capacities, which finds the smallest sufficient room in
steps of its height.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemill.llm.bpe import SLICE, load_encoder
from rulemill.llm.common import fresh

CAPACITY = 2048
SHARD_BYTES = 16 << 20  # of text; a shard's ids follow them
PAD = 0
CACHED_WORDS = 1 << 20  # entries of a worker's word tables: 200 MB each


class RoomTree:
    """Rows by their room. A node says whether any leaf below it has a row."""

    def __init__(self, capacity: int):
        self.width = 1
        while self.width <= capacity:
            self.width *= 2
        self.full = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        at = room + self.width
        while at:
            self.full[at] += 1
            at //= 2

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``need``, and that room."""
        at = need + self.width
        if not self.full[at]:
            while at > 1 and (at % 2 or not self.full[at + 1]):  # up until a right neighbour has rows
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if self.full[2 * at] else 2 * at + 1
        room = at - self.width
        while at:
            self.full[at] -= 1
            at //= 2
        return self.rows[room].pop(), room


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """The row of each piece, for sizes in falling order, none above ``capacity``."""
    tree, rows, out = RoomTree(capacity), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            row, room = rows, capacity
            rows += 1
        else:
            row, room = found
        if room > size:
            tree.add(row, room - size)
        out.append(row)
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Packed rows: shard, row, ids, ids_sha256, n_tokens, cu_seqlens, resets, doc_rows, doc_ids, pieces.

    ``ids`` is one row of the id matrix, ``capacity`` little-endian unsigned
    integers padded with 0: of two bytes where every id fits, else of four.
    ``cu_seqlens`` has the cumulative segment lengths from 0 on; ``resets`` the
    places where positions start at 0 again; ``doc_rows``, ``doc_ids`` and ``pieces`` say which
    piece of which row, and of which document, a segment is, so rows of one id or of none stay apart. ``ids_sha256`` is of
    ``ids``. A null or empty text is a segment with
    only the end id; repeated rows are packed each; a null id stays null; an empty
    table gives no rows. Other columns are dropped, so none can clash.
    """
    spark = docs.sparkSession
    encoder = load_encoder(tokenizer, CACHED_WORDS)
    width = 2 if max(len(encoder.labels), end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast(encoder)
    source = docs.select(F.monotonically_increasing_id().alias("at"), F.col(f"`{key}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("body"))
    kind = source.schema["doc"].dataType.simpleString()
    size = source.agg(F.sum(F.octet_length("body") + 8).alias("n")).first()["n"] or 1
    shards = int(-(-size // shard_bytes))
    tail = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, step = shared.value, capacity * width
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                row, piece, ids = [], [], []
                for k, body in enumerate(part.column(2).to_pylist()):
                    found = coder.encode(body) + tail
                    if width == 2:
                        found = np.frombuffer(found, "<u4").astype("<u2").tobytes()
                    count = -(-len(found) // step)
                    row += [k] * count
                    piece += range(count)
                    ids += [found[a:a + step] for a in range(0, len(found), step)]
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row, pa.int64())) for c in part.columns[:2]), pa.array(piece, pa.int32()), pa.array(ids, pa.binary())], ["at", "doc", "piece", "ids"])

    pieces = source.mapInArrow(cut, f"at long, doc {kind}, piece int, ids binary")
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("at", "piece"), F.lit(shards)).cast("int"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        n = pdf["ids"].map(len).to_numpy() // width
        order = np.lexsort((pdf["piece"].to_numpy(), pdf["at"].to_numpy(), -n))
        pdf, n = pdf.iloc[order], n[order]
        row = np.array(best_fit(n.tolist(), capacity), np.int64)
        out = []
        order = np.argsort(row, kind="stable")
        rows_, docs_, parts, ids = pdf["at"].tolist(), pdf["doc"].tolist(), pdf["piece"].tolist(), pdf["ids"].tolist()
        for group in np.split(order, np.flatnonzero(np.diff(row[order])) + 1):
            ends = np.cumsum(n[group])
            body = b"".join(ids[k] for k in group).ljust(capacity * width, PAD.to_bytes(1, "little"))
            out.append((int(pdf["shard"].iloc[0]), int(row[group[0]]), body, hashlib.sha256(body).hexdigest(), int(ends[-1]),
                        [0, *ends.tolist()], [0, *ends[:-1].tolist()], [rows_[k] for k in group], [None if pd.isna(docs_[k]) else docs_[k] for k in group], [parts[k] for k in group]))
        return pd.DataFrame(out, columns=["shard", "row", "ids", "ids_sha256", "n_tokens", "cu_seqlens", "resets", "doc_rows", "doc_ids", "pieces"])

    return pieces.groupBy("shard").applyInPandas(
        fill, f"shard int, row long, ids binary, ids_sha256 string, n_tokens int, cu_seqlens array<int>, resets array<int>, doc_rows array<long>, doc_ids array<{kind}>, pieces array<int>")


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as files; readers take any row alone."""
    packed.write.mode("overwrite").option("compression", "zstd").parquet(path)


def unpack(spark: SparkSession, path: str, width: int = 2) -> DataFrame:
    """The documents' ids from written rows: doc_row, doc_id, ids (little-endian 32-bit, with
    the end id), one for each row that was packed, also of repeated and null ids."""
    packed = spark.read.parquet(path)
    at = fresh(packed, "at")
    segments = packed.select("ids", F.posexplode("doc_rows").alias(at, "doc_row"), "doc_ids", "pieces", "cu_seqlens").select(
        "doc_row", F.get("doc_ids", at).alias("doc_id"), F.element_at("pieces", F.col(at) + 1).alias("piece"),
        F.expr(f"substring(ids, 1 + {width} * element_at(cu_seqlens, {at} + 1), {width} * (element_at(cu_seqlens, {at} + 2) - element_at(cu_seqlens, {at} + 1)))").alias("part"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = b"".join(pdf.sort_values("piece")["part"])
        return pd.DataFrame({"doc_row": [pdf["doc_row"].iloc[0]], "doc_id": pd.Series([pdf["doc_id"].iloc[0]], dtype=pdf["doc_id"].dtype), "ids": [np.frombuffer(whole, f"<u{width}").astype("<u4").tobytes()]})

    return segments.groupBy("doc_row").applyInPandas(join, f"doc_row long, doc_id {dict(segments.dtypes)['doc_id']}, ids binary")
