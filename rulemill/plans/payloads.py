"""Queries for request-log analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulemill.operators import payloads as pl
from rulemill.plans.catalog import query
from rulemill.session import shared_dir
from rulemill.sources import derived as de
from rulemill.sources.tables import load
from rulemill.streaming.limits import limit_stream, session_for_state
from rulemill.streaming.usage import all_windows, drain, read_split, session_stream, split_late, usage_stream
from rulemill.streaming.validate import read_stream


@query("""SELECT event_id, event_type AS endpoint, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events
          ORDER BY ts DESC, event_id DESC LIMIT 10""")
def latest_payloads(spark, sf_dir):
    return pl.latest(de.payload(spark, sf_dir), 10).select(
        "event_id", "endpoint", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def decode_props(spark, sf_dir):
    return pl.decode_field(load(spark, sf_dir, "events"), "props", "k", "bigint").select("event_id", "k")


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 3 THEN 3 WHEN 4 THEN 1 ELSE 0 END AS n_rules,
                 CASE event_id % 6 WHEN 0 THEN '[{"rule":"a"},{"rule":"b"}]'
                      WHEN 1 THEN '[{"rule":"' || event_type || '"}]'
                      WHEN 3 THEN '[{"column":"' || event_type || '","rule":"x > 0"},{"rule":"b"},{"rule":"c"}]'
                      WHEN 4 THEN '[{"rule":"d"}]' ELSE '[]' END AS rules FROM events""")
def decode_rules(spark, sf_dir):
    """Rules as predictions, as a plain list, as text and as a list inside predictions, and junk."""
    kind = F.col("event_id") % 6
    body = (F.when(kind == 0, '{"predictions":[{"rule":"a"},{"rule":"b"}]}')
            .when(kind == 1, F.concat(F.lit('[{"rule":"'), "event_type", F.lit('"}]')))
            .when(kind == 2, "service unavailable")
            .when(kind == 3, F.concat(F.lit('{"predictions":[{"rules":"[{\\"column\\":\\"'), "event_type",
                                      F.lit('\\",\\"rule\\":\\"x > 0\\"},{\\"rule\\":\\"b\\"}]","n":2},{"rule":"c"}]}')))
            .when(kind == 4, '{"predictions":[{"rules":[{"rule":"d"}]},{"rules":"not json"}]}'))
    log = load(spark, sf_dir, "events").withColumn("body", body)
    return pl.decode_rules(log, "body").select("event_id", "n_rules", "rules")


@query("""SELECT conv_id, turn, md5(text) AS request_md5, length(text) AS request_chars,
                 md5(response) AS response_md5, coalesce(length(response), 0) AS response_chars FROM (
            SELECT conv_id, turn, role, text,
                   CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS response
            FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) t WHERE role = 'user'""")
def pair_turns(spark, sf_dir):
    pairs = pl.pair_turns(load(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return pairs.select("conv_id", "turn", F.md5("request").alias("request_md5"), F.length("request").alias("request_chars"),
                        F.md5("response").alias("response_md5"), F.coalesce(F.length("response"), F.lit(0)).alias("response_chars"))


@query("""SELECT event_id, call_no, call_no > 3 AS limited FROM (
            SELECT event_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS call_no
            FROM events) t""")
def rate_limit_batch(spark, sf_dir):
    return pl.rate_limit(load(spark, sf_dir, "events"), 3, "day", ["user_id"]).select(
        "event_id", "call_no", "limited")


@query("""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
                 count(*) AS calls, round(sum(value), 4) AS volume FROM events GROUP BY 1, 2""")
def usage_windows(spark, sf_dir):
    return pl.usage_windows(load(spark, sf_dir, "events"), "1 hour", ["event_type"], "value")


@query("""SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts) + CAST(s * 6 - 18 AS INTEGER) * INTERVAL 1 HOUR,
                          '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS calls,
                 round(sum(value), 4) AS volume FROM events, range(0, 4) r(s) GROUP BY 1, 2""")
def usage_windows_sliding(spark, sf_dir):
    return pl.usage_windows(load(spark, sf_dir, "events"), "24 hours", ["event_type"], "value", slide="6 hours")


@query("""SELECT coalesce(event_type, 'ALL') AS event_type, coalesce(day, 'ALL') AS day, count(*) AS calls,
                 round(sum(value), 4) AS volume, CAST(grouping(event_type) * 2 + grouping(day) AS BIGINT) AS level
          FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, value FROM events) t
          GROUP BY ROLLUP (event_type, day)""")
def usage_rollup(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return pl.usage(e, ["event_type", "day"], "value")


@query("SELECT doc_id, " + ", ".join(
    f"regexp_matches(text, '{p}') AS has_{k}" for k, p in pl.GUARDRAILS.items())
    + ", concat_ws(',', " + ", ".join(
        f"CASE WHEN regexp_matches(text, '{p}') THEN '{k}' END" for k, p in pl.GUARDRAILS.items())
    + ") AS flags FROM documents")
def guardrail_docs(spark, sf_dir):
    return pl.guardrails(load(spark, sf_dir, "documents").select("doc_id", "text"), "text").drop("text")


_EDGES = [1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0]
_CUR = "ts >= TIMESTAMP '2024-01-16 00:00:00'"


def _psi_sql(expr, cur, edges, relation):
    bucket = "CASE " + " ".join(f"WHEN {expr} < {e} THEN {i}" for i, e in enumerate(edges)) + f" ELSE {len(edges)} END"
    return f"""
    SELECT round(sum((q - p) * ln(q / p)), 6) FROM (
      SELECT greatest(CAST(count(*) FILTER (WHERE NOT ({cur})) AS DOUBLE) / max(nb), 1e-6) AS p,
             greatest(CAST(count(*) FILTER (WHERE {cur}) AS DOUBLE) / max(nc), 1e-6) AS q
      FROM {relation}, (SELECT count({expr}) FILTER (WHERE NOT ({cur})) AS nb,
                               count({expr}) FILTER (WHERE {cur}) AS nc FROM {relation}) n
      WHERE {expr} IS NOT NULL GROUP BY {bucket}) s"""


@query(f"""SELECT 'value' AS column_name, count(*) FILTER (WHERE NOT ({_CUR})) AS n_baseline,
                  count(*) FILTER (WHERE {_CUR}) AS n_current,
                  ({_psi_sql('value', _CUR, _EDGES, '(SELECT ts, CASE WHEN event_id % 7 = 0 AND ' + _CUR + ' THEN NULL ELSE value END AS value FROM events) e')}) AS psi,
                  round(avg(value) FILTER (WHERE {_CUR}) - avg(value) FILTER (WHERE NOT ({_CUR})), 6) AS mean_shift,
                  round((1.0 - CAST(count(value) FILTER (WHERE {_CUR}) AS DOUBLE) / count(*) FILTER (WHERE {_CUR}))
                        - (1.0 - CAST(count(value) FILTER (WHERE NOT ({_CUR})) AS DOUBLE)
                           / count(*) FILTER (WHERE NOT ({_CUR}))), 6) AS null_rate_shift
           FROM (SELECT ts, CASE WHEN event_id % 7 = 0 AND {_CUR} THEN NULL ELSE value END AS value FROM events) t""")
def drift_events(spark, sf_dir):
    current = F.expr("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    e = load(spark, sf_dir, "events").withColumn(
        "value", F.when(~((F.col("event_id") % 7 == 0) & current), F.col("value")))
    return pl.drift(e, current, "value", _EDGES)


@query(f"""WITH c AS (SELECT event_type AS category, count(*) FILTER (WHERE NOT ({_CUR})) AS n_baseline,
                             count(*) FILTER (WHERE {_CUR}) AS n_current FROM events GROUP BY 1),
                s AS (SELECT *, CAST(n_baseline AS DOUBLE) / (SELECT sum(n_baseline) FROM c) AS p,
                             CAST(n_current AS DOUBLE) / (SELECT sum(n_current) FROM c) AS q FROM c)
           SELECT category, n_baseline, n_current, round(p, 6) AS baseline_share, round(q, 6) AS current_share,
                  round(q - p, 6) AS share_shift, round((q - p) * ln(q / p), 6) AS psi_part FROM s""")
def drift_categories(spark, sf_dir):
    current = F.expr("ts >= TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    return pl.drift_categories(load(spark, sf_dir, "events"), current, "event_type")


@query("""WITH b AS (SELECT quantile_cont(n_chars, 0.99) AS hi, count(*) AS n FROM documents),
               r AS (SELECT lang, source FROM documents GROUP BY 1, 2 HAVING count(*) < (SELECT n FROM b) * 0.005),
               d AS (SELECT doc_id, n_chars, lang, source,
                            concat_ws(',', CASE WHEN n_chars > (SELECT hi FROM b) THEN 'long' END,
                                           CASE WHEN length(trim(text)) < 20 THEN 'short' END,
                                           CASE WHEN (lang, source) IN (SELECT (lang, source) FROM r) THEN 'rare' END)
                              AS reasons FROM documents)
          SELECT * FROM d WHERE reasons <> ''""")
def edge_cases_docs(spark, sf_dir):
    return pl.edge_cases(load(spark, sf_dir, "documents"), "doc_id", "text", "n_chars", ["lang", "source"],
                         0.99, 0.005)


@query("""SELECT doc_id, quality, toxic, lang, pick FROM (
            SELECT l.doc_id, quality, toxic, lang, row_number() OVER (
                     PARTITION BY quality, toxic, lang ORDER BY md5(CAST(l.doc_id AS VARCHAR)), l.doc_id) AS pick
            FROM labels l JOIN documents d ON d.doc_id = l.doc_id) t WHERE pick <= 5""")
def eval_set(spark, sf_dir):
    labelled = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return pl.eval_set(labelled, ["quality", "toxic", "lang"], "doc_id", 5).select(
        "doc_id", "quality", "toxic", "lang", "pick")


_CLOSED = "(SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 2 HOUR"


# The stream's last event closes every window that ended a delay before it; the others come from the state.
@query(f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS calls,
                 round(sum(value), 4) AS volume, w + INTERVAL 1 HOUR <= {_CLOSED} AS closed
          FROM (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type, value FROM events) t GROUP BY w, event_type""")
def stream_usage(spark, sf_dir):
    out = shared_dir(spark, "stream-usage")
    drain(usage_stream(read_stream(spark, sf_dir, "events"), "1 hour", "2 hours", ["event_type"], "value"), out)
    return all_windows(spark, out, ["event_type"]).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "calls", F.round("volume", 4).alias("volume"), "closed")


@query(f"""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS first
                     FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
               s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g),
               k AS (SELECT user_id, no, min(ts) AS started, max(ts) AS ended, count(*) AS calls FROM s GROUP BY 1, 2)
          SELECT strftime(started, '%Y-%m-%d %H:%M:%S') AS window_start, user_id, calls, ended + INTERVAL 6 HOUR <= {_CLOSED} AS closed FROM k""")
def stream_sessions(spark, sf_dir):
    out = shared_dir(spark, "stream-sessions")
    drain(session_stream(read_stream(spark, sf_dir, "events"), "6 hours", "2 hours", ["user_id"], "value"), out)
    return all_windows(spark, out, ["user_id"]).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "user_id", "calls", "closed")


# Two deliveries, the second with a third of all events and much of it late.
_LATE = "event_id % 3 = 0 AND ts < (SELECT max(ts) FROM events WHERE event_id % 3 <> 0) - INTERVAL 36 HOUR"


@query(f"""SELECT event_type, event_id % 3 = 0 AS second_delivery, coalesce({_LATE}, false) AS late, count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id
           FROM events GROUP BY 1, 2, 3""")
def stream_late(spark, sf_dir):
    out, events = shared_dir(spark, "stream-late"), load(spark, sf_dir, "events")
    for delivered in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        events.where(delivered).write.mode("append").parquet(f"{out}/in")
        split_late(spark.readStream.schema(events.schema).parquet(f"{out}/in"), f"{out}/out", "36 hours")
    rows = read_split(spark, f"{out}/out", events.schema)
    return rows.groupBy("event_type", (F.col("batch") > 0).alias("second_delivery"), "late").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


_SLIDING = """SELECT user_id AS key, event_id AS id, pos - older AS call_no, pos - older > 3 AS limited FROM (
    SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS pos,
           coalesce(count(*) OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) // 3600000 RANGE BETWEEN UNBOUNDED PRECEDING AND 24 PRECEDING), 0) AS older
    FROM events WHERE user_id IS NOT NULL) t"""


@query(_SLIDING)
def rate_limit_sliding(spark, sf_dir):
    return pl.sliding_limit(load(spark, sf_dir, "events"), 3, 24 * 3_600_000, 24, "user_id", "event_id")


@query(_SLIDING)
def stream_rate_limit(spark, sf_dir):
    own, out = session_for_state(spark), shared_dir(spark, "stream-limit")
    limit_stream(read_stream(own, sf_dir, "events"), 3, 24 * 3_600_000, 24, "user_id", "event_id", out)
    return spark.read.parquet(f"{out}/rows")
