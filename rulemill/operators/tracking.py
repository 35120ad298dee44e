"""Run tracking: logs, search, comparison, promotion, latency, traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rulemill.functions.quantiles import exact_quantiles
from rulemill.session import checkpointed


def log_metrics(wide: DataFrame, id_col: str, ts_col: str, keys: list[str]) -> DataFrame:
    """Metric columns to long rows (id, key, value, ts)."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys])
    return (wide.select(F.col(id_col).alias("run_id"), F.inline(pairs), F.col(ts_col).alias("ts"))
            .where(F.col("value").isNotNull()))


def log_params(wide: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """Parameter columns to long rows (id, key, value), values as text."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])
    return wide.select(F.col(id_col).alias("run_id"), F.inline(pairs)).where(F.col("value").isNotNull())


def latest_metrics(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Last logged value of each key per run, as columns; equal times keep the
    larger value. Reduced before the shuffle, no pivot pass."""
    order = F.struct("ts", "value")
    return metrics.where(F.col("key").isin(*keys)).groupBy("run_id").agg(*[
        F.max(F.when(F.col("key") == k, order))["value"].alias(k) for k in keys])


def search_runs(metrics: DataFrame, keys: list[str], where: str, order_by: list[Column], n: int) -> DataFrame:
    """Runs passing a metric filter, best first, at most ``n``."""
    return latest_metrics(metrics, keys).where(where).orderBy(*order_by).limit(n)


def latest_run(runs: DataFrame, start_col: str = "started") -> DataFrame:
    """The most recently started run."""
    return runs.orderBy(F.desc(start_col), F.desc("run_id")).limit(1)


def compare_runs(metrics: DataFrame, first, second) -> DataFrame:
    """Metrics of two runs side by side; a missing value shows as ``N/A``."""
    picked = metrics.where(F.col("run_id").isin(first, second))
    both = picked.groupBy("key").agg(*[
        F.max(F.when(F.col("run_id") == r, F.struct("ts", "value")))["value"].alias(side)
        for r, side in ((first, "a"), (second, "b"))])

    def shown(c):
        return F.coalesce(F.round(c, 4).cast("decimal(20,4)").cast("string"), F.lit("N/A"))

    return both.select(F.col("key").alias("metric"), shown("a").alias("run_a"), shown("b").alias("run_b"),
                       F.round(F.col("b") - F.col("a"), 4).alias("difference"))


def append_runs(metrics: DataFrame, path: str, batch: int) -> str:
    """Append logged metrics (run_id, key, value, ts) to a run log; a batch that comes again replaces itself."""
    metrics.select("run_id", "key", "value", "ts").write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return path


def compare_all_runs(metrics: DataFrame, baseline, smaller_is_better: tuple[str, ...] = ()) -> DataFrame:
    """(metric, run_id, value, difference, is_best) of every run's last value: the difference to the ``baseline`` run
    and whether no run did better, the smaller value winning for the metrics named. Baseline and best values are one row a metric, so
    runs are never gathered."""
    last = metrics.groupBy("key", "run_id").agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
    smaller = F.col("key").isin(*smaller_is_better) if smaller_is_better else F.lit(False)
    per_key = last.groupBy("key").agg(
        F.max(F.when(F.col("run_id") == baseline, F.col("value"))).alias("_base"), F.min("value").alias("_low"), F.max("value").alias("_high"))
    return last.join(per_key, "key").select(
        F.col("key").alias("metric"), "run_id", F.round("value", 4).alias("value"), F.round(F.col("value") - F.col("_base"), 4).alias("difference"),
        (F.col("value") == F.when(smaller, F.col("_low")).otherwise(F.col("_high"))).alias("is_best"))


# The promotion thresholds.
MAX_LATENCY_SECONDS = 10.0
MIN_RULES = 5


def promote(runs: DataFrame, versions: DataFrame, policy: str = "winner",
            max_latency: float = MAX_LATENCY_SECONDS, min_rules: float = MIN_RULES) -> DataFrame:
    """Promotion decision per model name, one row each.

    The fastest run under the thresholds wins. ``policy='winner'`` promotes the
    newest version that run produced, ``'latest'`` the newest version of all.
    Names without a qualifying run say so.
    """
    ok = (F.col("latency_seconds") < max_latency) & (F.col("rules_generated") >= min_rules)
    # Version rows shrink to one per (name, run) before meeting the runs.
    made = versions.groupBy("name", "run_id").agg(F.max("version").alias("run_version"))
    best = F.when(ok, F.struct("latency_seconds", "run_id", "run_version"))
    picked = made.join(runs.select("run_id", "latency_seconds", "rules_generated"), "run_id").groupBy("name").agg(
        F.min(best).alias("best"), F.max("run_version").alias("newest"))
    target = F.col("best.run_version") if policy == "winner" else F.col("newest")
    found = F.col("best").isNotNull()
    return picked.select(
        "name", F.when(found, "promote").otherwise("no candidate").alias("decision"),
        F.coalesce(F.col("best.run_id"), F.lit(-1)).alias("run_id"),
        F.when(found, target).otherwise(F.lit(0)).cast("bigint").alias("version"))


def latency_stats(runs: DataFrame, value: str, by: tuple[str, ...]) -> DataFrame:
    """Count, mean and exact percentiles of a duration per configuration; a null
    configuration is one like others."""
    same = F.struct(*by).alias("_g")
    base = runs.groupBy(*by).agg(F.count(value).alias("n"), F.round(F.avg(value), 4).alias("mean"),
                                 F.max(value).alias("slowest"))
    q = exact_quantiles(runs, [value], [0.5, 0.95, 0.99], by)
    wide = q.groupBy(*by).agg(*[
        F.round(F.max(F.when(F.col("prob") == p, F.col("value"))), 4).alias(a)
        for p, a in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99"))])
    return base.withColumn("_g", same).join(wide.select(same, "p50", "p95", "p99"), "_g").drop("_g")


def ab_compare(scores: DataFrame, config: str, a: str, b: str, key: str, value: str) -> DataFrame:
    """Champion against challenger, paired by key; lower is better."""
    pair = scores.where(F.col(config).isin(a, b)).groupBy(key).agg(
        F.avg(F.when(F.col(config) == a, F.col(value))).alias("a"),
        F.avg(F.when(F.col(config) == b, F.col(value))).alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return pair.agg(
        F.count_if(both).alias("n_pairs"),
        F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"),
        F.count_if(F.col("a") < F.col("b")).alias("wins_a"), F.count_if(F.col("b") < F.col("a")).alias("wins_b"),
        F.round(F.avg(F.col("b") - F.col("a")), 4).alias("mean_delta"),
        F.round(F.try_divide(F.count_if(F.col("b") < F.col("a")), F.count_if(both)), 6).alias("win_rate_b"))


def _spanned(spans: DataFrame) -> DataFrame:
    """Adds ``_from`` and ``_to``, the span's interval in microseconds."""
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return spans.withColumn("_from", start).withColumn("_to", start + F.round(F.col("duration") * 1_000_000).cast("bigint"))


def covered_time(spans: DataFrame, slot_us: int = 60_000_000) -> DataFrame:
    """(parent_id, covered): the time in which at least one child of a span ran, inside the span itself.

    A sweep over each parent's children in order of their start: a child adds what lies behind the latest end so far. The latest end
    is carried over time slots as a small table, so only the children of one parent that start in one slot are sorted together.
    """
    timed = _spanned(spans)
    parents = timed.select(F.col("span_id").alias("parent_id"), F.col("_from").alias("_pf"), F.col("_to").alias("_pt"))
    inside = timed.where("parent_id IS NOT NULL").join(parents, "parent_id").select(
        "parent_id", F.greatest("_from", "_pf").alias("lo"), F.least("_to", "_pt").alias("hi")).where("lo < hi")
    inside = inside.withColumn("slot", F.floor(F.col("lo") / slot_us))
    latest = inside.groupBy("parent_id", "slot").agg(F.max("hi").alias("_end"))
    earlier = W.partitionBy("parent_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    carried = latest.select("parent_id", "slot", F.max("_end").over(earlier).alias("_carried"))
    within = W.partitionBy("parent_id", "slot").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
    swept = inside.withColumn("_seen", F.max("hi").over(within)).join(carried, ["parent_id", "slot"])
    reach = F.greatest("lo", "_seen", "_carried")  # nulls do not count
    return swept.groupBy("parent_id").agg((F.sum(F.greatest(F.col("hi") - reach, F.lit(0))) / 1_000_000).alias("covered"))


def span_self_time(spans: DataFrame, slot_us: int = 60_000_000) -> DataFrame:
    """Adds ``self_time``: a span's duration less the time in which its children ran, children that overlap counted once and only as
    far as they lie inside the span. Needs ``ts``, the span's start."""
    children = covered_time(spans, slot_us).withColumnRenamed("parent_id", "span_id")
    return spans.join(children, "span_id", "left").withColumn(
        "self_time", F.col("duration") - F.coalesce("covered", F.lit(0.0))).drop("covered")


def span_breakdown(spans: DataFrame, by: list[str]) -> DataFrame:
    return span_self_time(spans).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_spans"), F.round(F.sum("duration"), 4).alias("total_time"),
        F.round(F.sum("self_time"), 4).alias("self_time"))


def critical_path(spans: DataFrame) -> DataFrame:
    """(trace_id, depth, span_id, name, duration, own_time): from each root down, always the child that ended last,
    of equal ends the larger id. ``own_time`` is the span's time less its overlap with the next span on the path.

    Each span's last child is one reduction; then every path goes down by one level a round, one row per trace, each round
    written, until no path goes on. A span has one parent, so no path can run in a circle.
    """
    timed = _spanned(spans).select("trace_id", "span_id", "parent_id", "name", "duration", "_from", "_to")
    last = timed.where("parent_id IS NOT NULL").groupBy("trace_id", "parent_id").agg(
        F.max(F.struct("_to", "span_id", "name", "duration", "_from")).alias("c"))
    last = checkpointed(last, "last-child")
    at = checkpointed(timed.where("parent_id IS NULL").select("trace_id", F.lit(0).alias("depth"), "span_id", "name", "duration", "_from", "_to"), "path")
    levels = []
    while at.head(1):
        following = last.select("trace_id", F.col("parent_id").alias("span_id"), "c")
        met = at.join(following, ["trace_id", "span_id"], "left")
        overlap = F.greatest(F.least("_to", "c._to") - F.greatest("_from", "c._from"), F.lit(0)) / 1_000_000
        level = checkpointed(met.withColumn("own_time", F.round(F.col("duration") - F.when(F.col("c").isNotNull(), overlap).otherwise(0.0), 4)), "path")
        levels.append(level.select("trace_id", "depth", "span_id", "name", "duration", "own_time"))
        at = level.where("c IS NOT NULL").select("trace_id", (F.col("depth") + 1).alias("depth"), *[F.col(f"c.{x}").alias(x) for x in ("span_id", "name", "duration", "_from", "_to")])
    out = levels[0] if levels else at.select("trace_id", "depth", "span_id", "name", "duration", F.lit(0.0).alias("own_time"))
    for more in levels[1:]:
        out = out.unionByName(more)
    return out
