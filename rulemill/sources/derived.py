"""Tracking, registry and payload tables derived from the event stream.

The given tables hold no runs, versions or request logs, so these are built
from ``events`` by arithmetic that any engine repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulemill.functions.ordering import running_index
from rulemill.sources.tables import load


def model_name():
    return F.concat(F.lit("m"), (F.col("user_id") % 10).cast("string"))


def runs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user: metrics, the first event's type as prompt version, start time."""
    return (load(spark, sf_dir, "events").groupBy(F.col("user_id").alias("run_id"))
            .agg(F.count(F.lit(1)).cast("double").alias("rules_generated"),
                 F.round(F.avg("value") / 10, 9).alias("latency_seconds"),
                 F.count_if(F.col("event_type") == "signup").cast("double").alias("schema_rules"),
                 F.min_by("event_type", F.struct("ts", "event_id")).alias("prompt_version"),
                 F.min("ts").alias("started")))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metric log, several values per run and key; errors log no latency."""
    e = load(spark, sf_dir, "events")
    pairs = F.array(
        F.struct(F.lit("rules_generated").alias("key"), (F.col("event_id") % 13).cast("double").alias("value")),
        F.struct(F.lit("latency_seconds").alias("key"),
                 F.when(F.col("event_type") != "error", F.col("value") / 10).alias("value")))
    return (e.select(F.col("user_id").alias("run_id"), "ts", F.inline(pairs))
            .where(F.col("value").isNotNull()))


def version_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registration per signup."""
    return (load(spark, sf_dir, "events").where("event_type = 'signup'")
            .select(model_name().alias("name"), F.col("user_id").alias("run_id"), "ts",
                    F.col("event_id").alias("request_id")))


def alias_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alias move per purchase."""
    alias = F.when(F.col("event_id") % 2 == 0, "champion").otherwise("challenger")
    return (load(spark, sf_dir, "events").where("event_type = 'purchase'")
            .select(model_name().alias("name"), alias.alias("alias"), "ts", F.col("event_id").alias("request_id")))


def model_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model reference per view, by alias URI."""
    alias = F.when(F.col("event_id") % 3 == 0, "champion").otherwise("challenger")
    return (load(spark, sf_dir, "events").where("event_type = 'view'")
            .select(F.col("event_id").alias("ref_id"), "ts",
                    F.concat(F.lit("models:/"), model_name(), F.lit("@"), alias).alias("uri")))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span per event; a trace is a user's day and its first span the parent."""
    e = load(spark, sf_dir, "events").withColumn(
        "trace_id", F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")))
    roots = e.groupBy("trace_id").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("root"))
    return e.join(roots, "trace_id").select(
        "trace_id", F.col("event_id").alias("span_id"),
        F.when(F.col("event_id") != F.col("root"), F.col("root")).alias("parent_id"),
        F.col("event_type").alias("name"), "ts", F.col("value").alias("duration"))


def span_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span per event of a user's day; the k-th span's parent is the one at half its position."""
    e = load(spark, sf_dir, "events").withColumn(
        "trace_id", F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")))
    placed = running_index(e, ["trace_id"], ["ts", "event_id"], F.date_trunc("hour", F.col("ts").cast("timestamp")), out="k")
    above = placed.select("trace_id", F.col("k").alias("_up"), F.col("event_id").alias("parent_id"))
    return placed.withColumn("_up", F.floor(F.col("k") / 2)).join(above, ["trace_id", "_up"], "left").select(
        "trace_id", F.col("event_id").alias("span_id"), "parent_id", F.col("event_type").alias("name"), "ts", (F.col("value") * 60).alias("duration"))


def payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: event type as endpoint, user as key, value as latency."""
    return load(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").alias("endpoint"), F.col("user_id").alias("key"),
        F.col("value").alias("latency_ms"), F.col("props").alias("response"))
