"""Versions and aliases as append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulemill.functions.ordering import asof_join, running_index

# Reference formats models:/name@alias, models:/name/3, prompts:/name@alias.
URI = r"^(?:models|prompts):/([^@/]+)(?:@([^@/]+)|/([0-9]+))$"


def register(versions: DataFrame | None, requests: DataFrame, tie: str = "request_id") -> DataFrame:
    """Give each request the next integer version of its name, by time.

    Position within a name is counted by minute slots, so a name with a third of
    all requests is not sorted in one task.
    """
    numbered = running_index(requests, ["name"], ["ts", tie], F.date_trunc("minute", F.col("ts").cast("timestamp")))
    if versions is None:
        return numbered.withColumn("version", F.col("idx").cast("bigint")).drop("idx")
    last = versions.groupBy("name").agg(F.max("version").alias("_last"))
    return (numbered.join(last, "name", "left")
            .withColumn("version", (F.col("idx") + F.coalesce("_last", F.lit(0))).cast("bigint"))
            .drop("idx", "_last"))


def register_prompt(prompts: DataFrame | None, name: str, template: str, commit_message: str,
                    tags: dict[str, str], spark, ts) -> DataFrame:
    """One prompt version row with its commit text and tags."""
    schema = ("request_id bigint, name string, template string, commit_message string, "
              "tags map<string,string>, ts timestamp")
    return register(prompts, spark.createDataFrame([(0, name, template, commit_message, tags, ts)], schema))


def latest_versions(versions: DataFrame) -> DataFrame:
    """Newest version per name; compared as integers."""
    return versions.groupBy("name").agg(F.max(F.col("version").cast("bigint")).alias("version"))


def current_aliases(alias_log: DataFrame, tie: str = "request_id") -> DataFrame:
    """Last write per (name, alias)."""
    return alias_log.groupBy("name", "alias").agg(
        F.max_by("version", F.struct("ts", tie)).alias("version"))


def parse_uris(refs: DataFrame, uri_col: str = "uri") -> DataFrame:
    """Adds ``name``, ``alias`` and ``fixed_version`` (NULL where absent)."""
    def part(i):
        return F.nullif(F.regexp_extract(uri_col, URI, i), F.lit(""))
    return (refs.withColumn("name", part(1)).withColumn("alias", part(2))
            .withColumn("fixed_version", part(3).cast("bigint")))


def resolve(refs: DataFrame, alias_log: DataFrame, tie: str = "request_id") -> DataFrame:
    """Version each reference meant at its own time; NULL if the alias was unset.

    A reference by number resolves to that number.
    """
    parsed = parse_uris(refs)
    by_alias = asof_join(parsed.where(F.col("alias").isNotNull()),
                         alias_log.select("name", "alias", "ts", "version", tie),
                         ["name", "alias"], "ts", "version", tie)
    fixed = parsed.where(F.col("alias").isNull()).withColumn("version", F.col("fixed_version"))
    return by_alias.unionByName(fixed).drop("fixed_version")


def versions_with_aliases(versions: DataFrame, aliases: DataFrame) -> DataFrame:
    """Versions with their current aliases, sorted and comma-joined. The list is
    as long as a name has aliases."""
    held = aliases.groupBy("name", "version").agg(
        F.array_join(F.array_sort(F.collect_list("alias")), ",").alias("aliases"))
    return versions.join(held, ["name", "version"], "left").withColumn("aliases", F.coalesce("aliases", F.lit("")))


def rollback_target(alias_log: DataFrame, tie: str = "request_id") -> DataFrame:
    """Current version per alias, and the last one that differed from it.

    Two reductions instead of a window over the whole history of an alias.
    """
    current = current_aliases(alias_log, tie).withColumnRenamed("version", "current_version")
    before = (alias_log.join(current, ["name", "alias"])
              .where(F.col("version") != F.col("current_version"))
              .groupBy("name", "alias").agg(F.max_by("version", F.struct("ts", tie)).alias("rollback_version")))
    return current.join(before, ["name", "alias"], "left").withColumn(
        "rollback_version", F.coalesce("rollback_version", F.lit(0)))
