"""Streaming delta sync of an index table.

The stream appends reduced changes; the index is its base table with the last
change of each key applied. A batch therefore costs what it changes, not what
the index holds. Saving ``current_index`` as the next base compacts the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rulemill.operators.documents import upsert


def sync_stream(changes: DataFrame, out: str, key: str, seq: str) -> None:
    """Append the last change per key of each batch until the input is drained.

    A batch writes its own folder by batch number, so a batch replayed after a
    failure replaces what it wrote before.
    """
    rest = [c for c in changes.columns if c != key]

    def apply(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("_c")).select(key, "_c.*")
         .write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}"))

    (changes.writeStream.foreachBatch(apply).option("checkpointLocation", f"{out}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def current_index(spark: SparkSession, base: DataFrame, out: str, change_schema: StructType,
                  key: str, seq: str, op: str = "op") -> DataFrame:
    """``base`` with every change written so far."""
    log = spark.read.schema(change_schema).option("recursiveFileLookup", "true").parquet(f"{out}/changes")
    return upsert(base, log, key, seq, op)
