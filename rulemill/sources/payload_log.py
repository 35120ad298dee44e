"""Request/response log sink, partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def with_day(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    return df.withColumn("day", F.to_date(ts_col))


def append_log(df: DataFrame, path: str, ts_col: str = "ts") -> str:
    """Append rows to the log.

    The rebalance hint lets AQE gather small days into few files and split a
    day that holds most of the rows over many tasks.
    """
    (with_day(df, ts_col).hint("rebalance", "day")
        .write.mode("append").partitionBy("day").parquet(path))
    return path


def stream_log(sdf: DataFrame, path: str, checkpoint: str,
               ts_col: str = "ts") -> StreamingQuery:
    """The same sink for a stream; each start drains what has arrived."""
    return (with_day(sdf, ts_col).writeStream.format("parquet")
            .partitionBy("day").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_log(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
