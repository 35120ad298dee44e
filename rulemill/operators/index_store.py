"""An index table on plain files that is brought up to date bucket by bucket.

Rows lie in buckets by a hash of their key. A manifest names the version of each bucket that counts; a change set rewrites
only the buckets it touches, as files of a new version, and then writes the next manifest as one file. Until that file
is there readers see the old index, whole; what a failed attempt has written is replaced by the next one. The
manifest also names the last batch applied, so a batch that comes again changes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rulemill.operators.documents import upsert
from rulemill.session import remove

_MANIFEST = "bucket int, version int, buckets int, batch bigint, manifest int"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, path: str) -> tuple[int, int, int, dict[int, int]]:
    """(number, buckets, last batch, version by bucket) of the newest manifest; at most one row for each bucket."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
        newest = rows.agg(F.max("manifest")).scalar()
        found = rows.where(F.col("manifest") == newest).collect()
    except AnalysisException:
        found = []
    if not found:
        raise ValueError(f"no index at {path}")
    one = found[0]
    return one["manifest"], one["buckets"], one["batch"], {r["bucket"]: r["version"] for r in found if r["bucket"] >= 0}


def _publish(spark: SparkSession, path: str, number: int, buckets: int, batch: int, versions: dict[int, int]) -> None:
    rows = [(b, v, buckets, batch) for b, v in versions.items()] or [(-1, 0, buckets, batch)]
    frame = spark.createDataFrame(rows, "bucket int, version int, buckets int, batch bigint").coalesce(1)
    frame.write.mode("overwrite").parquet(f"{path}/manifest/manifest={number}")


def _write(rows: DataFrame, path: str, key: str, buckets: int, version: int) -> set[int]:
    """Write the rows as files of a version, one for each bucket; the buckets that have rows."""
    at = f"{path}/data/version={version}"
    rows.withColumn("bucket", _bucket(key, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
    spark, kind = rows.sparkSession, rows.schema
    written = spark.read.schema(StructType([*kind.fields, StructField("bucket", IntegerType())])).parquet(at)
    return {r["bucket"] for r in written.select("bucket").distinct().collect()}


def create_index(source: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Lay out ``source``, whose keys are unique, as the first version of an index."""
    _publish(source.sparkSession, path, 0, buckets, -1, {b: 0 for b in _write(source, path, key, buckets, 0)})


def _read(spark: SparkSession, path: str, schema: StructType, versions: dict[int, int]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], schema)
    parts = [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*parts)


def read_index(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The index as its newest manifest has it."""
    return _read(spark, path, schema, _manifest(spark, path)[3])


def apply_changes(changes: DataFrame, path: str, schema: StructType, key: str, seq: str, batch: int, op: str = "op") -> list[int]:
    """Apply upserts and deletes, the last change per key by ``seq``; the buckets that were rewritten.

    Only touched buckets are read, joined and written, so the work follows the change set. A batch numbered at or
    below the last one applied does nothing. Null keys are refused.
    """
    spark = changes.sparkSession
    number, buckets, last, versions = _manifest(spark, path)
    if batch <= last:
        return []
    keyed = changes.withColumn("_bucket", F.when(F.col(f"`{key}`").isNull(), F.raise_error(F.lit("null key"))).otherwise(_bucket(key, buckets)))
    touched = sorted(r["_bucket"] for r in keyed.select("_bucket").distinct().collect())
    if touched:
        old = _read(spark, path, schema, {b: v for b, v in versions.items() if b in set(touched)})
        full = _write(upsert(old, changes, key, seq, op).select(*schema.names), path, key, buckets, number + 1)
        versions = {b: v for b, v in versions.items() if b not in set(touched)} | {b: number + 1 for b in full}
    _publish(spark, path, number + 1, buckets, batch, versions)
    return touched


def sync_index(changes: DataFrame, path: str, schema: StructType, key: str, seq: str, checkpoint: str, op: str = "op") -> None:
    """Apply a stream of changes batch by batch until its input is drained."""
    (changes.writeStream.foreachBatch(lambda rows, n: apply_changes(rows, path, schema, key, seq, n, op) and None)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def vacuum(spark: SparkSession, path: str) -> list[int]:
    """Remove versions that the newest manifest does not name any more, and older manifests; the versions removed.
    Not while another reader is at work on an older manifest."""
    number, _, _, versions = _manifest(spark, path)
    gone = [v for v in range(number + 1) if v not in set(versions.values())]
    for v in gone:
        remove(spark, f"{path}/data/version={v}")
    for k in range(number):
        remove(spark, f"{path}/manifest/manifest={k}")
    return gone
