"""Queries for run tracking and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import tracking as tr
from rulemill.operators.versions import register
from rulemill.plans.catalog import query
from rulemill.session import shared_dir
from rulemill.sources import derived as de
from rulemill.sources.tables import load

_RUNS_SQL = """
    SELECT user_id AS run_id, CAST(count(*) AS DOUBLE) AS rules_generated,
           round(avg(value) / 10, 9) AS latency_seconds,
           CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS schema_rules,
           arg_min(event_type, (ts, event_id)) AS prompt_version, min(ts) AS started
    FROM events GROUP BY 1"""
_LOG_SQL = """
    SELECT user_id AS run_id, ts, 'rules_generated' AS key, CAST(event_id % 13 AS DOUBLE) AS value FROM events
    UNION ALL SELECT user_id, ts, 'latency_seconds', value / 10 FROM events WHERE event_type <> 'error'"""
_LATEST_SQL = f"""
    SELECT run_id, arg_max(value, (ts, value)) FILTER (WHERE key = 'rules_generated') AS rules_generated,
           arg_max(value, (ts, value)) FILTER (WHERE key = 'latency_seconds') AS latency_seconds
    FROM ({_LOG_SQL}) m GROUP BY 1"""
_KEYS = ["rules_generated", "latency_seconds"]


@query(f"""SELECT run_id, key, value FROM (
             SELECT run_id, 'rules_generated' AS key, CAST(rules_generated AS VARCHAR) AS value FROM (
                 SELECT run_id, CAST(CAST(rules_generated AS DECIMAL(20,9)) AS VARCHAR) AS rules_generated FROM ({_RUNS_SQL}) a) x
             UNION ALL SELECT run_id, 'latency_seconds',
                 CAST(CAST(latency_seconds AS DECIMAL(20,9)) AS VARCHAR) FROM ({_RUNS_SQL}) b
             UNION ALL SELECT run_id, 'prompt_version', prompt_version FROM ({_RUNS_SQL}) c) t""")
def runs_long(spark, sf_dir):
    wide = de.runs_wide(spark, sf_dir)
    metrics = tr.log_metrics(wide, "run_id", "started", _KEYS).select(
        "run_id", "key", F.col("value").cast("decimal(20,9)").cast("string").alias("value"))
    return metrics.unionByName(tr.log_params(wide, "run_id", ["prompt_version"]))


@query(f"""SELECT run_id, rules_generated, round(latency_seconds, 4) AS latency_seconds FROM ({_LATEST_SQL}) t
           WHERE rules_generated >= 5 ORDER BY t.latency_seconds, run_id LIMIT 10""")
def search_runs(spark, sf_dir):
    found = tr.search_runs(de.metric_log(spark, sf_dir), _KEYS, "rules_generated >= 5",
                           [F.col("latency_seconds").asc_nulls_last(), F.col("run_id")], 10)
    return found.withColumn("latency_seconds", F.round("latency_seconds", 4))


@query(f"""SELECT run_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS started FROM ({_RUNS_SQL}) r
           ORDER BY r.started DESC, run_id DESC LIMIT 1""")
def latest_run(spark, sf_dir):
    return tr.latest_run(de.runs_wide(spark, sf_dir)).select(
        "run_id", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"))


@query(f"""SELECT key AS metric,
                  coalesce(CAST(CAST(round(a, 4) AS DECIMAL(20,4)) AS VARCHAR), 'N/A') AS run_a,
                  coalesce(CAST(CAST(round(b, 4) AS DECIMAL(20,4)) AS VARCHAR), 'N/A') AS run_b,
                  round(b - a, 4) AS difference
           FROM (SELECT key, arg_max(value, (ts, value)) FILTER (WHERE run_id = 3) AS a,
                        arg_max(value, (ts, value)) FILTER (WHERE run_id = 7) AS b
                 FROM (SELECT * FROM ({_LOG_SQL}) l UNION ALL
                       SELECT user_id, ts, 'errors', 1.0 FROM events WHERE event_type = 'error' AND user_id = 3) m
                 WHERE run_id IN (3, 7) GROUP BY key) t""")
def compare_runs(spark, sf_dir):
    errors = load(spark, sf_dir, "events").where("event_type = 'error' AND user_id = 3").select(
        F.col("user_id").alias("run_id"), "ts", F.lit("errors").alias("key"), F.lit(1.0).alias("value"))
    return tr.compare_runs(de.metric_log(spark, sf_dir).unionByName(errors), 3, 7)


@query(f"""WITH l AS (SELECT key, run_id, arg_max(value, (ts, value)) AS value FROM ({_LOG_SQL}) m GROUP BY 1, 2),
                k AS (SELECT key, max(value) FILTER (WHERE run_id = 3) AS base, min(value) AS low, max(value) AS high FROM l GROUP BY 1)
           SELECT key AS metric, run_id, round(value, 4) AS value, round(value - base, 4) AS difference,
                  value = CASE WHEN key = 'latency_seconds' THEN low ELSE high END AS is_best FROM l JOIN k USING (key)""")
def compare_all_runs(spark, sf_dir):
    """Every run against run 3, over a log written in two batches, the second of them twice."""
    log, path = de.metric_log(spark, sf_dir), shared_dir(spark, "run-log")
    for batch, rows in ((0, log.where("run_id % 2 = 0")), (1, log.where("run_id % 2 = 1")), (1, log.where("run_id % 2 = 1"))):
        tr.append_runs(rows, path, batch)
    return tr.compare_all_runs(spark.read.parquet(path), 3, ("latency_seconds",))


VERSIONS_SQL = """
    SELECT 'm' || (user_id % 10) AS name, user_id AS run_id, ts, event_id AS request_id,
           row_number() OVER (PARTITION BY user_id % 10 ORDER BY ts, event_id) AS version
    FROM events WHERE event_type = 'signup'"""


def _promotion_sql(policy, max_latency):
    target = "b.run_version" if policy == "winner" else "n.newest"
    return f"""
    WITH made AS (SELECT name, run_id, max(version) AS run_version FROM ({VERSIONS_SQL}) v GROUP BY 1, 2),
         j AS (SELECT * FROM made JOIN ({_RUNS_SQL}) r USING (run_id)),
         ok AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY latency_seconds, run_id) AS rn FROM j
                WHERE latency_seconds < {max_latency} AND rules_generated >= 5),
         n AS (SELECT name, max(run_version) AS newest FROM j GROUP BY 1)
    SELECT '{policy}' AS policy, n.name, CASE WHEN b.name IS NULL THEN 'no candidate' ELSE 'promote' END AS decision,
           coalesce(b.run_id, -1) AS run_id, CASE WHEN b.name IS NULL THEN 0 ELSE {target} END AS version
    FROM n LEFT JOIN (SELECT * FROM ok WHERE rn = 1) b ON b.name = n.name"""


@query(f"""SELECT * FROM ({_promotion_sql('winner', 10.0)}) a UNION ALL
           SELECT * FROM ({_promotion_sql('latest', 10.0)}) b UNION ALL
           SELECT 'strict', name, decision, run_id, version FROM ({_promotion_sql('winner', 4.2)}) c""")
def promotion_decision(spark, sf_dir):
    runs = de.runs_wide(spark, sf_dir)
    versions = register(None, de.version_requests(spark, sf_dir))
    parts = [tr.promote(runs, versions, "winner").withColumn("policy", F.lit("winner")),
             tr.promote(runs, versions, "latest").withColumn("policy", F.lit("latest")),
             tr.promote(runs, versions, "winner", max_latency=4.2).withColumn("policy", F.lit("strict"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean, max(value) AS slowest,
                 round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95,
                 round(quantile_cont(value, 0.99), 4) AS p99 FROM events GROUP BY 1""")
def latency_stats(spark, sf_dir):
    return tr.latency_stats(load(spark, sf_dir, "events"), "value", ("event_type",))


@query("""SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS n_pairs,
                 count(*) FILTER (WHERE b IS NULL) AS only_a, count(*) FILTER (WHERE a IS NULL) AS only_b,
                 count(*) FILTER (WHERE a < b) AS wins_a, count(*) FILTER (WHERE b < a) AS wins_b,
                 round(avg(b - a), 4) AS mean_delta,
                 round(CAST(count(*) FILTER (WHERE b < a) AS DOUBLE)
                       / count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL), 6) AS win_rate_b
          FROM (SELECT k, a, b FROM
                  (SELECT strftime(ts, '%m-%d %H') AS k, avg(value) AS a FROM events WHERE event_type = 'click' GROUP BY 1) x
                  FULL JOIN
                  (SELECT strftime(ts, '%m-%d %H') AS k, avg(value) AS b FROM events WHERE event_type = 'view' GROUP BY 1) y
                  USING (k)) t""")
def ab_compare(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("hour", F.date_format("ts", "MM-dd HH"))
    return tr.ab_compare(e, "event_type", "click", "view", "hour", "value")


_SPANS_SQL = """
    SELECT trace_id, event_id AS span_id, CASE WHEN event_id <> root THEN root END AS parent_id, event_type AS name, value AS duration,
           epoch_us(ts) AS lo, epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) AS hi
    FROM (SELECT *, first_value(event_id) OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS root
          FROM (SELECT *, user_id || '/' || strftime(ts, '%Y-%m-%d') AS trace_id FROM events) a) b"""


@query(f"""WITH s AS ({_SPANS_SQL}),
                i AS (SELECT c.parent_id, greatest(c.lo, p.lo) AS lo, least(c.hi, p.hi) AS hi FROM s c JOIN s p ON p.span_id = c.parent_id),
                w AS (SELECT *, max(hi) OVER (PARTITION BY parent_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
                      FROM i WHERE lo < hi),
                c AS (SELECT parent_id, sum(greatest(hi - greatest(lo, coalesce(seen, lo)), 0)) / 1000000.0 AS child FROM w GROUP BY 1)
           SELECT trace_id, name, count(*) AS n_spans, round(sum(duration), 4) AS total_time,
                  round(sum(duration - coalesce(child, 0.0)), 4) AS self_time
           FROM s LEFT JOIN c ON c.parent_id = s.span_id GROUP BY 1, 2""")
def span_breakdown(spark, sf_dir):
    return tr.span_breakdown(de.spans(spark, sf_dir), ["trace_id", "name"])


@query("""WITH RECURSIVE k AS (
               SELECT *, row_number() OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS k FROM (
                 SELECT event_id, event_type, ts, value * 60 AS duration, user_id || '/' || strftime(ts, '%Y-%m-%d') AS trace_id FROM events) e),
             s AS (SELECT c.trace_id, c.event_id AS span_id, p.event_id AS parent_id, c.event_type AS name, c.duration, epoch_us(c.ts) AS lo,
                          epoch_us(c.ts) + CAST(round(c.duration * 1000000) AS BIGINT) AS hi
                   FROM k c LEFT JOIN k p ON p.trace_id = c.trace_id AND p.k = c.k // 2),
             l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY hi DESC, span_id DESC) AS rn FROM s WHERE parent_id IS NOT NULL) r WHERE rn = 1),
             path AS (SELECT trace_id, 0 AS depth, span_id, name, duration, lo, hi FROM s WHERE parent_id IS NULL
                      UNION ALL SELECT l.trace_id, path.depth + 1, l.span_id, l.name, l.duration, l.lo, l.hi FROM path JOIN l ON l.parent_id = path.span_id)
          SELECT path.trace_id, path.depth, path.span_id, path.name, path.duration,
                 round(path.duration - CASE WHEN l.span_id IS NULL THEN 0.0
                                       ELSE greatest(least(path.hi, l.hi) - greatest(path.lo, l.lo), 0) / 1000000.0 END, 4) AS own_time
          FROM path LEFT JOIN l ON l.parent_id = path.span_id""")
def trace_critical_path(spark, sf_dir):
    return tr.critical_path(de.span_tree(spark, sf_dir))
