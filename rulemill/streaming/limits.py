"""Rate limits over a sliding period, kept per key while the calls stream in."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_for_state(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams may use keyed state with timers."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    return own


class SlidingLimit(StatefulProcessor):
    """State of a key: a ring of ``slots`` counts and the newest slot. A timer drops the state of a key
    that has made no call for a whole period."""

    def __init__(self, n: int, slots: int, slot_ms: int):
        self.n, self.slots, self.slot_ms = n, slots, slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "newest bigint, counts array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest, counts = (int(self.ring.get()[0]), [int(c) for c in self.ring.get()[1]]) if self.ring.exists() else (None, [0] * self.slots)
        calls = pd.concat(list(rows)).sort_values(["ms", "id"])
        out = []
        for call, ms in zip(calls["id"].tolist(), calls["ms"].tolist(), strict=True):
            slot = ms // self.slot_ms
            if newest is None or slot > newest:
                passed = self.slots if newest is None else min(self.slots, slot - newest)
                for k in range(passed):
                    counts[(slot - k) % self.slots] = 0
                newest = slot
            if slot <= newest - self.slots:  # older than all that is kept
                out.append((call, None, None))
                continue
            counts[slot % self.slots] += 1
            number = sum(counts[s % self.slots] for s in range(newest - self.slots + 1, slot + 1))
            out.append((call, number, number > self.n))
        self.ring.update((newest, counts))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
        self.handle.registerTimer((newest + self.slots + 1) * self.slot_ms)
        frame = pd.DataFrame(out, columns=["id", "call_no", "limited"])
        yield frame.assign(call_no=frame["call_no"].astype("Int64"), limited=frame["limited"].astype("boolean"), key=key[0])[["key", "id", "call_no", "limited"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.ring.clear()
        return iter(())

    def close(self) -> None:
        pass


def limit_stream(sdf: DataFrame, n: int, period_ms: int, slots: int, key: str, call: str, out: str, ts: str = "ts", delay: str = "0 seconds") -> None:
    """Write (key, id, call_no, limited) for every call until the input is drained.

    ``call_no`` counts the key's calls, this one included, in the slot of the call and the slots before it that make up one period;
    calls beyond ``n`` are limited. Calls are taken in order of time and id within a batch, so deliveries in order of time
    give the batch answer ``payloads.sliding_limit``. A call older than its key's ring gets no number. Calls without a time or
    key are left out. ``sdf`` must come from ``session_for_state``. State per key is one ring, whatever its traffic.
    """
    timed = sdf.withColumn("event_time", F.col(ts).cast("timestamp")).where(F.col("event_time").isNotNull() & F.col(key).isNotNull())
    calls = timed.withWatermark("event_time", delay).select(F.col(key).alias("key"), F.col(call).alias("id"), F.unix_millis("event_time").alias("ms"), "event_time")
    kinds = dict(calls.dtypes)
    numbered = calls.groupBy("key").transformWithStateInPandas(
        SlidingLimit(n, slots, period_ms // slots), f"key {kinds['key']}, id {kinds['id']}, call_no bigint, limited boolean", "Append", "EventTime")
    (numbered.writeStream.format("parquet").outputMode("append").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
