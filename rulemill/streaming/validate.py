"""Streaming rule validation with clean and quarantine output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemill.functions.rules import Rule
from rulemill.operators.evaluate import tag


def read_stream(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """A table's files as a stream source."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(sf_dir)


def validate_stream(sdf: DataFrame, rules: list[Rule], out: str) -> None:
    """Tag every row and write it under ``rows/outcome=clean|quarantine``.

    Tagging is stateless, so there is no watermark. Each row is computed and
    written once. The file sink's log makes replayed batches exactly-once, and
    the run ends when the available input is drained.
    """
    tagged = tag(sdf, rules)
    outcome = F.when(F.col("failed_rules") == "", "clean").otherwise("quarantine")
    (tagged.withColumn("outcome", outcome).writeStream.format("parquet")
     .partitionBy("outcome").outputMode("append")
     .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
