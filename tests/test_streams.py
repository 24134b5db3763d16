"""Keyed state with timers: hours close without an event, state goes after long silence."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from waitlens.streaming import monitor, silence

START = datetime(2024, 1, 1)


@pytest.fixture
def stream(spark, tmp_path):
    """Appends a drop of (hours after the start, name) and runs the stream over what is new."""
    schema = "ts timestamp_ntz, event_type string"

    def run(rows, **options):
        rows = [(START + timedelta(hours=h), name) for h, name in rows]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        new = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        closed = silence.watch_silence(new, **{"periods": 2, "since": START, **options})
        out = silence.drain(closed, str(tmp_path / "out"), str(tmp_path / "check"))
        return {(r.event, int((r.hour - START).total_seconds() // 3600)): (r.event_count, r.stale) for r in out.collect()}

    return run


def test_silent_hours_raise_the_alarm_without_an_event(spark, stream, tmp_path):
    stream([(0.1, "a"), (0.2, "b"), (1.5, "a"), (1.6, "a")])
    got = stream([(5.5, "b")])
    # Only b said anything after hour 1, and a's hours closed all the same.
    assert got == {
        ("a", 0): (1, False), ("a", 1): (2, False), ("a", 2): (0, False), ("a", 3): (0, True), ("a", 4): (0, True),
        ("b", 0): (1, False), ("b", 1): (0, False), ("b", 2): (0, True), ("b", 3): (0, True), ("b", 4): (0, True),
    }
    got = stream([(7.2, "a")])
    assert got["b", 5] == (1, False) and got["a", 5] == (0, True) and got["b", 6] == (0, False)
    batch = monitor.staleness(spark.read.parquet(str(tmp_path / "in")), periods=2)
    want = {(r.event, int((r.hour - START).total_seconds() // 3600)): (r.event_count, r.stale) for r in batch.collect()}
    assert got == {k: v for k, v in want.items() if k[1] < 7}


def test_a_forgotten_name_starts_anew(stream):
    stream([(0.1, "a"), (0.2, "clock")], since=None, forget_after=3)
    got = stream([(9.5, "clock")], since=None, forget_after=3)
    assert [h for n, h in sorted(got) if n == "a"] == [0, 1, 2, 3]
    got = stream([(10.2, "a"), (12.5, "clock")], since=None, forget_after=3)
    assert [h for n, h in sorted(got) if n == "a"] == [0, 1, 2, 3, 10, 11]
    assert got["a", 10] == (1, False)


def test_late_events_within_the_delay_count(stream):
    stream([(0.1, "a"), (2.5, "a")], delay="3 hours", since=None)
    got = stream([(0.9, "a"), (8.0, "a")], delay="3 hours", since=None)
    assert got["a", 0] == (2, False) and got["a", 2] == (1, False) and got["a", 4] == (0, True)
    # Later than that: the hour is closed and stays as it was.
    got = stream([(1.1, "a"), (8.1, "a")], delay="3 hours", since=None)
    assert got["a", 1] == (0, False)
