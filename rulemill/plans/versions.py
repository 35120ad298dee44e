"""Queries for versions and aliases."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from rulemill.functions.ordering import asof_join
from rulemill.operators import versions as ve
from rulemill.plans.catalog import query
from rulemill.plans.tracking import VERSIONS_SQL
from rulemill.session import checkpointed
from rulemill.sources import derived as de

# Alias moves point at the newest version of the name at that time.
_ALIAS_SQL = f"""
    SELECT a.name, a.alias, a.ts, a.request_id, v.version FROM
      (SELECT 'm' || (user_id % 10) AS name, CASE WHEN event_id % 2 = 0 THEN 'champion' ELSE 'challenger' END AS alias,
              ts, event_id AS request_id FROM events WHERE event_type = 'purchase') a
      ASOF JOIN ({VERSIONS_SQL}) v ON a.name = v.name AND a.ts >= v.ts"""
_CURRENT_SQL = f"""SELECT name, alias, arg_max(version, (ts, request_id)) AS version
                   FROM ({_ALIAS_SQL}) l GROUP BY 1, 2"""


def versions(spark, sf_dir):
    return ve.register(None, de.version_requests(spark, sf_dir))


def alias_log(spark, sf_dir):
    """The alias log is a table, so it is written once and read by its users."""
    made = versions(spark, sf_dir).select("name", "ts", "version", "request_id")
    moves = asof_join(de.alias_requests(spark, sf_dir), made, ["name"], "ts", "version", "request_id")
    return checkpointed(moves.where(F.col("version").isNotNull()), "alias-log")


@query(f"SELECT name, run_id, request_id, version FROM ({VERSIONS_SQL}) v")
def register_versions(spark, sf_dir):
    """Half of the month is registered, then the rest on top of it."""
    requests = de.version_requests(spark, sf_dir)
    first = ve.register(None, requests.where("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    later = ve.register(first, requests.where("ts >= TIMESTAMP_NTZ '2024-01-15 00:00:00'"))
    return first.unionByName(later).select("name", "run_id", "request_id", "version")


@query(_CURRENT_SQL)
def current_aliases(spark, sf_dir):
    return ve.current_aliases(alias_log(spark, sf_dir))


@query(f"""SELECT r.ref_id, r.name, r.alias, coalesce(l.version, 0) AS version FROM
             (SELECT event_id AS ref_id, ts, 'm' || (user_id % 10) AS name,
                     CASE WHEN event_id % 3 = 0 THEN 'champion' ELSE 'challenger' END AS alias
              FROM events WHERE event_type = 'view') r
             ASOF LEFT JOIN ({_ALIAS_SQL}) l ON r.name = l.name AND r.alias = l.alias AND r.ts >= l.ts""")
def resolve_alias_asof(spark, sf_dir):
    return ve.resolve(de.model_refs(spark, sf_dir), alias_log(spark, sf_dir)).select(
        "ref_id", "name", "alias", F.coalesce("version", F.lit(0)).alias("version"))


@query(f"""SELECT v.name, v.version, coalesce(c.aliases, '') AS aliases FROM ({VERSIONS_SQL}) v LEFT JOIN
             (SELECT name, version, string_agg(alias, ',' ORDER BY alias) AS aliases
              FROM ({_CURRENT_SQL}) k GROUP BY 1, 2) c ON c.name = v.name AND c.version = v.version""")
def versions_with_aliases(spark, sf_dir):
    current = ve.current_aliases(alias_log(spark, sf_dir))
    return ve.versions_with_aliases(versions(spark, sf_dir), current).select("name", "version", "aliases")


@query(f"SELECT name, max(version) AS version FROM ({VERSIONS_SQL}) v GROUP BY 1")
def latest_versions(spark, sf_dir):
    return ve.latest_versions(versions(spark, sf_dir))


@query(f"""SELECT c.name, c.alias, c.version AS current_version, coalesce(p.version, 0) AS rollback_version
           FROM ({_CURRENT_SQL}) c LEFT JOIN
             (SELECT l.name, l.alias, arg_max(l.version, (l.ts, l.request_id)) AS version
              FROM ({_ALIAS_SQL}) l JOIN ({_CURRENT_SQL}) k ON k.name = l.name AND k.alias = l.alias
              WHERE l.version <> k.version GROUP BY 1, 2) p ON p.name = c.name AND p.alias = c.alias""")
def rollback_target(spark, sf_dir):
    return ve.rollback_target(alias_log(spark, sf_dir))


@query("""SELECT v.name, count(*) + 1 AS version, 'rules for {{table}}' AS template, 'shorter' AS commit_message, 'prod' AS stage
          FROM (SELECT 'm' || (user_id % 10) AS name FROM events WHERE event_type = 'signup') v WHERE v.name = 'm3' GROUP BY 1""")
def register_prompt(spark, sf_dir):
    """The next version of a prompt on top of those registered before it."""
    known = ve.register(None, de.version_requests(spark, sf_dir))
    made = ve.register_prompt(known, "m3", "rules for {{table}}", "shorter", {"stage": "prod"}, spark, datetime.datetime(2030, 1, 1))
    return made.select("name", "version", "template", "commit_message", F.col("tags")["stage"].alias("stage"))
