"""Request/response log analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rulemill.functions.ordering import running_index
from rulemill.functions.quantiles import exact_quantiles
from rulemill.functions.text import EMAIL

# Default guardrail patterns.
GUARDRAILS = {
    "email": EMAIL,
    "secret": r"(AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{16,}|[Pp]assword *[:=])",
    "phone": r"[+][0-9]{1,3}[ -]?[0-9]{2,4}[ -]?[0-9]{3,}",
    "markup": r"<(script|iframe)",
}


def latest(log: DataFrame, n: int, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Newest ``n`` rows; a distributed top-n."""
    return log.orderBy(F.desc(ts), F.desc(tie)).limit(n)


def decode_rules(log: DataFrame, body: str) -> DataFrame:
    """Rule list out of a JSON response. Adds ``n_rules`` and ``rules`` (JSON).

    A response is ``{"predictions": [...]}`` or a list. A prediction that has
    ``rules``, a list or its JSON text, stands for these; any other is a rule
    itself. Unreadable responses and rule texts give an empty list.
    """
    whole = F.try_parse_json(body)
    listed = F.coalesce(F.try_variant_get(whole, "$.predictions", "array<variant>"), F.try_variant_get(whole, "$", "array<variant>"))
    nothing = F.array().cast("array<variant>")

    def rules_of(v):
        own = F.try_variant_get(v, "$.rules", "variant")
        text = F.try_parse_json(F.try_variant_get(v, "$.rules", "string"))
        read = F.coalesce(F.try_variant_get(own, "$", "array<variant>"), F.try_variant_get(text, "$", "array<variant>"), nothing)
        return F.when(own.isNotNull(), read).otherwise(F.array(v))

    rules = F.flatten(F.transform(F.coalesce(listed, nothing), rules_of))
    return log.withColumn("_rules", rules).withColumn("n_rules", F.size("_rules").cast("bigint")).withColumn(
        "rules", F.to_json("_rules")).drop("_rules")


def decode_field(log: DataFrame, body: str, field: str, dtype: str) -> DataFrame:
    """One typed field out of a JSON body; NULL where it is absent or unreadable."""
    return log.withColumn(field, F.get_json_object(body, f"$.{field}").try_cast(dtype))


def pair_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each user turn with the turn that follows it, if an assistant gave it.

    Turns get a gapless position, then an equi join on (conversation, position)
    replaces a look-ahead over whole conversations.
    """
    placed = running_index(turns.select(conv, turn, role, text), [conv], [turn],
                           F.floor(F.col(turn) / 1000), out="_at")
    asked = placed.where(F.col(role) == "user").select(
        conv, turn, F.col(text).alias("request"), (F.col("_at") + 1).alias("_at"))
    answered = placed.where(F.col(role) == "assistant").select(conv, "_at", F.col(text).alias("response"))
    return asked.join(answered, [conv, "_at"], "left").drop("_at")


def rate_limit(log: DataFrame, n: int, period: str, key: list[str], ts: str = "ts",
               tie: str = "event_id", slot: str = "minute") -> DataFrame:
    """Adds ``call_no`` within (key, period) and ``limited`` for calls beyond ``n``.

    Calls are numbered by ``slot``, so one key with most of the traffic of a
    period is spread over the slots of that period.
    """
    stamp = F.col(ts).cast("timestamp")
    keyed = log.withColumn("period_start", F.date_trunc(period, stamp))
    numbered = running_index(keyed, [*key, "period_start"], [ts, tie], F.date_trunc(slot, stamp), out="call_no")
    return numbered.withColumn("limited", F.col("call_no") > n)


def sliding_limit(log: DataFrame, n: int, period_ms: int, slots: int, key: str, call: str, ts: str = "ts") -> DataFrame:
    """(key, id, call_no, limited): calls of the key in the call's slot, up to it, and in the slots before that make up one period.

    The position among all calls of the key less the calls of older slots: both come from slot totals, and only one
    slot of one key is sorted together. Calls without a time or key are left out.
    """
    slot_ms = period_ms // slots
    calls = log.select(F.col(key).alias("key"), F.col(call).alias("id"), F.unix_millis(F.col(ts).cast("timestamp")).alias("ms")).dropna(subset=["key", "ms"])
    calls = calls.withColumn("slot", F.floor(F.col("ms") / slot_ms))
    placed = running_index(calls, ["key"], ["ms", "id"], F.col("slot"), out="at")
    totals = calls.groupBy("key", "slot").agg(F.count(F.lit(1)).alias("m"))
    older = F.coalesce(F.sum("m").over(W.partitionBy("key").orderBy("slot").rangeBetween(W.unboundedPreceding, -slots)), F.lit(0))
    joined = placed.join(totals.select("key", "slot", older.alias("older")), ["key", "slot"])
    number = F.col("at") - F.col("older")
    return joined.select("key", "id", number.alias("call_no"), (number > n).alias("limited"))


def usage_windows(log: DataFrame, duration: str, keys: list[str], value: str, ts: str = "ts",
                  slide: str | None = None) -> DataFrame:
    """Calls and volume per tumbling (or sliding) window and key."""
    w = F.window(F.col(ts).cast("timestamp"), duration, slide) if slide else F.window(
        F.col(ts).cast("timestamp"), duration)
    return (log.groupBy(w.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("calls"), F.round(F.sum(value), 4).alias("volume"))
            .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), *keys, "calls", "volume"))


def usage(log: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Calls and volume by key with subtotals; rolled-up keys read ``ALL``."""
    rolled = log.rollup(*keys).agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.sum(value), 4).alias("volume"),
        F.grouping_id().cast("bigint").alias("level"),
        *[F.grouping(k).alias(f"_g_{k}") for k in keys])
    shown = [F.when(F.col(f"_g_{k}") == 1, "ALL").otherwise(F.col(k).cast("string")).alias(k) for k in keys]
    return rolled.select(*shown, "calls", "volume", "level")


def guardrails(df: DataFrame, col: str, patterns: dict[str, str] | None = None) -> DataFrame:
    """Adds one Boolean per pattern and the joined names of those that hit."""
    patterns = patterns or GUARDRAILS
    hits = {k: F.col(col).rlike(p) for k, p in patterns.items()}
    return df.withColumns({f"has_{k}": h for k, h in hits.items()}).withColumn(
        "flags", F.concat_ws(",", *[F.when(F.col(f"has_{k}"), k) for k in hits]))


_FLOOR = 1e-6


def _psi(p: Column, q: Column) -> Column:
    p, q = F.greatest(p, F.lit(_FLOOR)), F.greatest(q, F.lit(_FLOOR))
    return (q - p) * F.ln(q / p)


def drift(df: DataFrame, is_current: Column, col: str, edges: list[float]) -> DataFrame:
    """Population stability of a number between baseline and current rows.

    One pass and one row: counts per fixed bucket, null rates and means.
    """
    cur, base = is_current, ~is_current
    v = F.col(col)
    bounds = [None, *edges, None]
    buckets = []
    for lo, hi in zip(bounds, bounds[1:]):
        cond = v.isNotNull()
        if lo is not None:
            cond = cond & (v >= lo)
        if hi is not None:
            cond = cond & (v < hi)
        buckets.append(cond)
    aggs = [F.count_if(base & v.isNotNull()).alias("_nb"), F.count_if(cur & v.isNotNull()).alias("_nc"),
            F.count_if(base).alias("_rb"), F.count_if(cur).alias("_rc"),
            F.avg(F.when(base, v)).alias("_mb"), F.avg(F.when(cur, v)).alias("_mc")]
    for i, b in enumerate(buckets):
        aggs += [F.count_if(base & b).alias(f"_b{i}"), F.count_if(cur & b).alias(f"_c{i}")]
    one = df.agg(*aggs)
    psi = sum((_psi(F.try_divide(F.col(f"_b{i}"), F.col("_nb")), F.try_divide(F.col(f"_c{i}"), F.col("_nc")))
               for i in range(len(buckets))), F.lit(0.0))
    null_rate = lambda n, r: F.lit(1.0) - F.try_divide(F.col(n), F.col(r))
    return one.select(
        F.lit(col).alias("column_name"), F.col("_rb").alias("n_baseline"), F.col("_rc").alias("n_current"),
        F.round(psi, 6).alias("psi"), F.round(F.col("_mc") - F.col("_mb"), 6).alias("mean_shift"),
        F.round(null_rate("_nc", "_rc") - null_rate("_nb", "_rb"), 6).alias("null_rate_shift"))


def drift_categories(df: DataFrame, is_current: Column, col: str) -> DataFrame:
    """Share of each category in baseline and current rows, and its part of the PSI.

    Counts come first; totals are scalar subqueries over the counts.
    """
    counts = df.groupBy(col).agg(F.count_if(~is_current).alias("n_baseline"), F.count_if(is_current).alias("n_current"))
    p = F.try_divide(F.col("n_baseline"), counts.agg(F.sum("n_baseline")).scalar())
    q = F.try_divide(F.col("n_current"), counts.agg(F.sum("n_current")).scalar())
    return counts.select(
        F.col(col).cast("string").alias("category"), "n_baseline", "n_current",
        F.round(p, 6).alias("baseline_share"), F.round(q, 6).alias("current_share"),
        F.round(q - p, 6).alias("share_shift"), F.round(_psi(p, q), 6).alias("psi_part"))


def edge_cases(df: DataFrame, key: str, text: str, length: str, category: list[str],
               tail: float = 0.99, rare_share: float = 0.02) -> DataFrame:
    """Rows that are extreme: very long, nearly empty, or of a rare category.

    The length bound is an exact quantile read as a scalar; rare categories are
    a counted list joined by equality.
    """
    bound = exact_quantiles(df, [length], [tail]).select("value").scalar()
    total = df.agg(F.count(F.lit(1))).scalar()
    shares = df.groupBy(*category).agg(F.count(F.lit(1)).alias("_n"))
    same = F.struct(*category)  # nulls in it are equal
    rare = shares.where(F.col("_n") < total * rare_share).select(same.alias("_g"), F.lit(True).alias("_rare"))
    reasons = F.concat_ws(
        ",", F.when(F.col(length) > bound, "long"),
        F.when(F.length(F.trim(text)) < 20, "short"), F.when(F.col("_rare"), "rare"))
    return (df.withColumn("_g", same).join(rare, "_g", "left").withColumn("reasons", reasons)
            .where(F.col("reasons") != "").select(key, length, *category, "reasons"))


def eval_set(df: DataFrame, strata: list[str], key: str, n: int) -> DataFrame:
    """``n`` rows per stratum, chosen by hash of the key: the same on any run.

    Spark cuts each task to ``n`` rows per stratum before the shuffle.
    """
    order = W.partitionBy(*strata).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= n)
