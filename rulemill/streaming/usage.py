"""Streaming usage counts and sessions with a bound on late data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _windowed(sdf: DataFrame, window: Column, keys: list[str], delay: str, value: str) -> DataFrame:
    return (sdf.withWatermark("event_time", delay).groupBy(window.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("calls"), F.sum(value).alias("volume"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, "calls", "volume"))


def usage_stream(sdf: DataFrame, duration: str, delay: str, keys: list[str], value: str, ts: str = "ts",
                 slide: str | None = None) -> DataFrame:
    """Calls per window and key. State is one partial sum per open window and
    key; windows older than the newest time less ``delay`` are closed and sent."""
    timed = sdf.withColumn("event_time", F.col(ts).cast("timestamp"))
    window = F.window("event_time", duration, slide) if slide else F.window("event_time", duration)
    return _windowed(timed, window, keys, delay, value)


def session_stream(sdf: DataFrame, gap: str, delay: str, keys: list[str], value: str, ts: str = "ts") -> DataFrame:
    """Calls per activity session of a key."""
    timed = sdf.withColumn("event_time", F.col(ts).cast("timestamp"))
    return _windowed(timed, F.session_window("event_time", gap), keys, delay, value)


def drain(sdf: DataFrame, out: str) -> None:
    """Append closed windows to files under ``rows`` until the input is drained."""
    (sdf.writeStream.format("parquet").outputMode("append")
     .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def open_windows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Windows or sessions that ``drain`` has left open, read from the query's state store: they end
    after the watermark, so later input may still change them."""
    state = spark.read.format("statestore").load(f"{out}/checkpoint")
    in_value = "session_window" in state.schema["value"].dataType.names
    window = F.col("value.session_window") if in_value else F.col("key.window")
    total = next(n for n in state.schema["value"].dataType.names if n.startswith("sum"))
    return state.select(window["start"].alias("window_start"), window["end"].alias("window_end"),
                        *[F.col(f"key.{k}").alias(k) for k in keys], F.col("value.count").alias("calls"), F.col(f"value.{total}").alias("volume"))


def all_windows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Closed windows from the files and open ones from the state, told apart by ``closed``. Together they
    hold every row that was not late."""
    closed = spark.read.parquet(f"{out}/rows").withColumn("closed", F.lit(True))
    return closed.unionByName(open_windows(spark, out, keys).withColumn("closed", F.lit(False)).select(*closed.columns))


def split_late(sdf: DataFrame, out: str, delay: str, ts: str = "ts") -> None:
    """Write every row once, under ``rows/batch=N/late=true|false``, until the input is drained.

    A row is late if it is older than the newest time of all batches before its own, less ``delay``: what a
    windowed aggregate with that watermark could drop is kept here, apart. A row without a time is not late. The newest time goes along with
    each batch as its mark; a batch that is replayed reads the mark before it and replaces its own folder, so it gives the same rows.
    """
    schema = "newest timestamp"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(schema).parquet(f"{out}/marks/batch={batch_id - 1}").first()["newest"] if batch_id else None
        time = F.col(ts).cast("timestamp")
        bound = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        marked = batch.withColumn("late", F.coalesce(time < bound, F.lit(False)))
        marked.write.mode("overwrite").partitionBy("late").parquet(f"{out}/rows/batch={batch_id}")
        newest = batch.agg(F.greatest(F.max(time), F.lit(before).cast("timestamp")).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{out}/marks/batch={batch_id}")

    (sdf.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def read_split(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The rows ``split_late`` wrote, with ``batch`` and ``late``."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(whole).parquet(f"{out}/rows")
