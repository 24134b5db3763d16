"""Event counts in time windows, threshold alarms and staleness alarms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.functions.temporal import hour_start


def event_windows(
    events: DataFrame,
    ts: str = "ts",
    event: str = "event_type",
    width: str = "5 minutes",
    watermark: str | None = None,
) -> DataFrame:
    """Events per tumbling window and name. Give a watermark when ``events`` is a stream."""
    if watermark:
        events = events.withWatermark(ts, watermark)
    return (
        events.groupBy(F.window(ts, width).alias("_w"), F.col(event).alias("event"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
            "event", "event_count",
        )
    )


def threshold_alarm(windows: DataFrame, names: Sequence[str], threshold: int = 1) -> DataFrame:
    """Windows in which a watched event reached the threshold. No data means no alarm."""
    return windows.where(F.col("event").isin(*names) & (F.col("event_count") >= threshold)).select(
        "window_start", "event", "event_count", F.lit("ALARM").alias("state")
    )


def staleness(
    events: DataFrame,
    periods: int,
    ts: str = "ts",
    event: str = "event_type",
    names: Sequence[str] | None = None,
    until: Column | None = None,
    threshold: int = 1,
) -> DataFrame:
    """Hours in which an event has been below the threshold ``periods`` hours in a row.

    Missing hours count as empty, so silence raises the alarm. Each event is judged on
    the hours from the first to the last event of all (or ``until``); the events are
    reduced to hourly counts first, and the hour spine grows with time, not with rows.
    """
    hour = hour_start(F.col(ts))
    kept = events if names is None else events.where(F.col(event).isin(*names))
    counts = kept.groupBy(F.col(event).alias("event"), hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # The range is two values; each event's hours are then laid out where the event is.
    first, last = counts.agg(F.min("hour"), F.max("hour")).first()
    begin = F.lit(first).cast("timestamp_ntz")
    end = F.lit(last).cast("timestamp_ntz") if until is None else hour_start(until)
    hours = counts.select("event").distinct().select(
        "event", F.explode(F.sequence(begin, end, F.expr("INTERVAL 1 HOUR"))).alias("hour")
    )
    recent = Window.partitionBy("event").orderBy("hour").rowsBetween(-(periods - 1), 0)
    filled = hours.join(counts, ["event", "hour"], "left").select(
        "event", "hour", F.coalesce("n", F.lit(0)).alias("event_count")
    )
    judged = filled.select(
        "*",
        F.sum(F.when(F.col("event_count") >= threshold, 1).otherwise(0)).over(recent).alias("_alive"),
        F.count(F.lit(1)).over(recent).alias("_seen"),
    )
    return judged.select(
        "event",
        "hour",
        "event_count",
        ((F.col("_seen") == periods) & (F.col("_alive") == 0)).alias("stale"),
    )
