"""Staleness on a stream: hours that stay below a threshold raise the alarm as they end.

Events are counted per hour first, by a windowed aggregation with a watermark, so however
frequent an event is, only its hourly counts reach the keyed state. Each name then has a
state of its own (the next hour to close, its count so far, how many quiet hours lie behind
it) and a timer at the end of that hour. The timer, not an event, closes the hour: an hour
without any event is judged like the others once the watermark has passed it, or, by the
clock, once it is over. A name that has been quiet for long enough is forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from waitlens.functions.temporal import epoch_micros, from_epoch

HOUR = 3_600_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "event string, hour_ms long, event_count long, stale boolean"


class QuietHours(StatefulProcessor):
    """Closes hours by timers; one row per closed hour of a name."""

    def __init__(self, periods: int, threshold: int, forget_after: int | None, since_ms: int | None, by_clock: bool):
        self.periods, self.threshold = periods, threshold
        self.forget_after, self.since_ms, self.by_clock = forget_after, since_ms, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "hour long", "n long")
        self.place = handle.getValueState("place", "next long, quiet long")

    def _now(self, timers) -> int:
        return timers.getCurrentProcessingTimeInMs() if self.by_clock else timers.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = None
        for row in rows:
            hour = row.hour_ms
            first = hour if first is None else min(first, hour)
            if self.place.exists() and hour < self.place.get()[0]:
                continue  # its hour is closed
            before = self.counts.getValue((hour,))[0] if self.counts.containsKey((hour,)) else 0
            self.counts.updateValue((hour,), (before + row.n,))
        if first is not None and not self.place.exists():
            start = first if self.since_ms is None else min(first, self.since_ms)
            self.place.update((start, 0))
            self.handle.registerTimer(start + HOUR)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self._now(timerValues)
        hour, quiet = self.place.get()
        out = []
        while hour + HOUR <= now:
            n = self.counts.getValue((hour,))[0] if self.counts.containsKey((hour,)) else 0
            if n:
                self.counts.removeKey((hour,))
            quiet = 0 if n >= self.threshold else quiet + 1
            out.append(Row(event=key[0], hour_ms=hour, event_count=n, stale=quiet >= self.periods))
            hour += HOUR
            if self.forget_after is not None and quiet >= self.forget_after and not self.counts.exists():
                self.place.clear()
                break
        else:
            self.place.update((hour, quiet))
            self.handle.registerTimer(hour + HOUR)
        return iter(out)

    def close(self) -> None:
        pass


def watch_silence(
    events: DataFrame,
    periods: int,
    ts: str = "ts",
    event: str = "event_type",
    names: Sequence[str] | None = None,
    threshold: int = 1,
    delay: str = "0 seconds",
    since: datetime | None = None,
    forget_after: int | None = 24 * 30,
    by_clock: bool = False,
) -> DataFrame:
    """(event, hour, event_count, stale) of a stream, one row as each hour of a name closes.

    Equal to ``monitor.staleness`` over the hours closed so far, except that a name is
    judged from its own first hour, or from ``since`` if that is earlier. ``delay`` is how
    late events may come. ``forget_after`` quiet hours a name's state goes; an event that
    comes later starts it anew. ``by_clock`` closes hours by processing time, for streams
    on which nothing at all may arrive; event hours are then taken as they come.
    Needs the RocksDB state store (``ROCKS``).
    """
    kept = events if names is None else events.where(F.col(event).isin(*names))
    # The instant in UTC whatever the session zone, as the watermark wants a timestamp.
    micros = F.timestamp_micros(epoch_micros(F.col(ts)))
    at = kept.select(F.col(event).cast("string").alias("event"), micros.alias("_at"))
    hourly = (
        at.withWatermark("_at", delay)
        .groupBy(F.window("_at", "1 hour").alias("_w"), "event")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("event", F.unix_millis("_w.start").alias("hour_ms"), "n", F.window_time("_w").alias("_closed"))
    )
    start = None if since is None else int(since.replace(tzinfo=UTC).timestamp() * 1000) // HOUR * HOUR
    closed = hourly.groupBy("event").transformWithState(
        QuietHours(periods, threshold, forget_after, start, by_clock),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="ProcessingTime" if by_clock else "EventTime",
    )
    return closed.select(
        "event", from_epoch("SECOND", F.col("hour_ms") / 1000).alias("hour"), "event_count", "stale"
    )


def drain(closed: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what has arrived, append the closed hours to Parquet files and read those."""
    spark = closed.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        query = (
            closed.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    return spark.read.schema(closed.schema).parquet(path)
