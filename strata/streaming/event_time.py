"""Event-time streams with bounded state: dedup, windows, interval matches and per-key rules (T4, 2.12).

Every operator here keeps state only for as long as the watermark calls for it: the greatest event time seen, less
``delay``.  A row is late when the watermark has passed what it could still change; late rows are dropped by that rule and
by no other, so the result of a replayed or restarted stream is the same.

``drain`` runs a stream over everything that has arrived and appends its rows to a parquet table with Spark's file sink, which
commits every micro-batch once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def event_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files that land below a folder."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what has arrived, append finished rows to ``path``, stop."""
    (stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


# -- dedup ----------------------------------------------------------------------------------------


def dedup_bounded(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """T4 with bounded state: the first row of a key passes; repeats are dropped until the watermark is ``delay`` past it.

    A key is forgotten after that, so state holds the keys of the last ``delay`` only, and a repeat that comes later
    passes again.  Use the keyed form (``deduplication_mode``) where a key must be unique for ever.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


# -- windows --------------------------------------------------------------------------------------


def tumbling(stream: DataFrame, time: str, every: str, delay: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Windows of equal length; a window is given out once, when the watermark passes its end."""
    grouped = stream.withWatermark(time, delay).groupBy(F.window(time, every).alias("_window"), *keys).agg(*aggregates)
    return grouped.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *keys,
                          *[c for c in grouped.columns if c != "_window" and c not in keys])


def sessions(stream: DataFrame, time: str, gap: str, delay: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Rows of a key less than ``gap`` apart are one session; it is given out when the watermark passes its end."""
    grouped = stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("_window"), *keys).agg(*aggregates)
    return grouped.select(F.col("_window.start").alias("session_start"), F.col("_window.end").alias("session_end"), *keys,
                          *[c for c in grouped.columns if c != "_window" and c not in keys])


# -- interval match -------------------------------------------------------------------------------


def match_back(later: DataFrame, earlier: DataFrame, reference: str, key: str, later_time: str, earlier_time: str, within: str,
               delay: str) -> DataFrame:
    """Each row of ``later`` with the row of ``earlier`` that it refers to, at most ``within`` before it; without one if there is none.

    Both streams may be out of order by ``delay``.  State on either side lasts until the watermark rules a match
    out; a row without a match is given out then.  Column names of the two streams must differ.
    """
    a = later.withWatermark(later_time, delay)
    b = earlier.withWatermark(earlier_time, delay)
    near = ((F.col(reference) == F.col(key)) & (F.col(earlier_time) <= F.col(later_time))
            & (F.col(earlier_time) >= F.col(later_time) - F.expr(f"INTERVAL {within}")))
    return a.join(b, near, "left_outer")


# -- per-key rule ---------------------------------------------------------------------------------

ALERT = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("alert_ts", T.TimestampType()),
                      T.StructField("n_events", T.LongType()), T.StructField("first_ts", T.TimestampType())])


class Velocity(StatefulProcessor):
    """Alert when a user has ``limit`` events within ``seconds``; one alert for an unbroken run of fast events.

    Events wait in state until the watermark has passed them and are then looked at in event-time order, so alerts do not
    depend on how events were cut into micro-batches or on their order within ``delay``.  State per user: waiting events, the times of
    the last ``seconds``, and whether the run has been reported.  One event-time timer a user is set to the earliest waiting
    event, or to the end of the run; when that passes, the user holds no state.
    """

    def __init__(self, limit: int, seconds: int):
        self.limit, self.span = limit, seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        times = T.StructType([T.StructField("ms", T.LongType())])
        self.handle = handle
        self.waiting, self.recent = handle.getListState("waiting", times), handle.getListState("recent", times)
        self.run = handle.getValueState("run", T.StructType([T.StructField("reported", T.BooleanType()), T.StructField("timer", T.LongType())]))

    def _state(self) -> tuple[bool, int]:
        state = self.run.get() if self.run.exists() else None
        return (bool(state[0]), int(state[1])) if state else (False, 0)

    def _set_timer(self, reported: bool, old: int, new: int) -> None:
        if new != old:
            if old:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        self.run.update((reported, new))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = [int(t.value) // 1_000_000 for part in rows for t in part["ts"]]
        self.waiting.appendList([(ms,) for ms in new])
        reported, timer = self._state()
        waits = timer if timer and any(int(r[0]) == timer for r in self.waiting.get()) else 0
        self._set_timer(reported, timer, min([*new, waits] if waits else new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        reported, timer = self._state()
        if expiredTimerInfo.getExpiryTimeInMs() != timer:
            return
        waiting, recent, alerts = sorted(int(r[0]) for r in self.waiting.get()), sorted(int(r[0]) for r in self.recent.get()), []
        for ms in (x for x in waiting if x <= passed):
            if recent and ms - recent[-1] >= self.span:
                reported = False
            recent = [x for x in recent if x > ms - self.span] + [ms]
            if len(recent) >= self.limit and not reported:
                reported = True
                alerts.append((int(key[0]), pd.Timestamp(ms, unit="ms"), len(recent), pd.Timestamp(recent[0], unit="ms")))
        later = [x for x in waiting if x > passed]
        if later:
            self.waiting.put([(x,) for x in later])
        else:
            self.waiting.clear()
        if later or recent and recent[-1] + self.span > passed:
            self.recent.put([(x,) for x in recent]) if recent else self.recent.clear()
            new = later[0] if later else recent[-1] + self.span
            self.handle.registerTimer(new)  # the old one has just fired
            self.run.update((reported, new))
        else:
            self.recent.clear()
            self.run.clear()
        if alerts:
            yield pd.DataFrame(alerts, columns=ALERT.names)

    def close(self) -> None:
        pass


def velocity_alerts(stream: DataFrame, limit: int, seconds: int, delay: str) -> DataFrame:
    """``user_id, alert_ts, n_events, first_ts`` over ``user_id, ts``."""
    timed = stream.select("user_id", "ts").withWatermark("ts", delay)
    return timed.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=Velocity(limit, seconds), outputStructType=ALERT, outputMode="append", timeMode="EventTime")
