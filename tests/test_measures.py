from __future__ import annotations

import random
import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from waitlens.operators.inequality import (
    stratified_median,
    stratified_rate,
    suppress_small,
    with_ridit,
    with_slope_indices,
)
from waitlens.operators.measures import (
    contains_flag,
    first_match,
    interval_breach,
    milestones,
    quantiles,
    stage_minutes,
    status_flag,
)
from waitlens.plans import reports

DAY0 = date(2024, 1, 1)


def _requests_and_events(spark, seed, hot=0.4, n=400, people=15):
    rng = random.Random(seed)
    who = lambda: None if rng.random() < 0.1 else ("hot" if rng.random() < hot else f"p{rng.randrange(people)}")
    requests = [(i, who(), DAY0 + timedelta(days=rng.randrange(60))) for i in range(n)]
    events = [
        (
            who(),
            datetime(2024, 1, 1) + timedelta(days=rng.randrange(90), hours=rng.randrange(3)),
            None if rng.random() < 0.05 else rng.randrange(-2, 40),
        )
        for _ in range(n)
    ]
    return (
        requests,
        events,
        spark.createDataFrame(requests, "id int, who string, day date"),
        spark.createDataFrame(events, "who string, at timestamp_ntz, gap int"),
    )


@pytest.mark.parametrize("seed,slack", [(1, 7), (2, 7), (3, 0), (4, 3)])
def test_first_match_against_brute_force(spark, seed, slack):
    requests, events, left, right = _requests_and_events(spark, seed)
    want = {}
    for i, who, day in requests:
        fits = [
            (at, gap)
            for w, at, gap in events
            if who is not None and w == who and gap is not None and gap <= (at.date() - day).days <= gap + slack
        ]
        want[i] = min(fits) if fits else (None, None)
    got = first_match(left, right, "who", "day", "at", "gap", slack)
    assert {r.id: (r.matched_at, r.matched_gap) for r in got.collect()} == want
    assert got.columns == ["id", "who", "day", "matched_at", "matched_gap"]


def test_first_match_keeps_microseconds_and_old_dates(spark):
    left = spark.createDataFrame([(1, "a", date(1950, 3, 1))], "id int, who string, day date")
    at = datetime(1950, 3, 5, 1, 2, 3, 456789)
    right = spark.createDataFrame([("a", at, 2)], "who string, at timestamp_ntz, gap int")
    row = first_match(left, right, "who", "day", "at", "gap").first()
    assert (row.matched_at, row.matched_gap) == (at, 2)


def test_first_match_joins_on_equality_alone(spark):
    _, _, left, right = _requests_and_events(spark, 1)
    plan = first_match(left, right.hint("merge"), "who", "day", "at", "gap")._jdf.queryExecution().optimizedPlan().toString()
    condition = plan.split("Join LeftOuter")[1].splitlines()[0]
    assert "who" in condition and "day" in condition and ">=" not in condition


def test_requests_without_a_key_are_scattered(spark):
    _, _, left, right = _requests_and_events(spark, 1)
    joined = first_match(left, right.hint("merge"), "who", "day", "at", "gap")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert any("hashpartitioning(who" in p and "_scatter" in p for p in plan.splitlines())


def test_first_match_shuffles_events_once_and_unrepeated(spark):
    left = spark.createDataFrame([(1, "a", date(2024, 1, 1))], "id int, who string, day date")
    start = datetime(2024, 1, 1)
    events = [(f"p{i}", start + timedelta(days=i % 900), i % 40) for i in range(20_000)]
    right = spark.createDataFrame(events, "who string, at timestamp_ntz, gap int").hint("merge")
    joined = first_match(left, right, "who", "day", "at", "gap")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().executedPlan()
    if plan.nodeName() == "ResultQueryStage":
        plan = plan.plan()
    stages = plan.collectLeaves()
    rows = [stages.apply(i).plan().metrics().apply("shuffleRecordsWritten").value() for i in range(stages.size())]
    assert len(rows) == 2 and max(rows) <= 20_000 * 9 // 8 + 1


def test_first_match_without_a_day_or_over_block_edges(spark):
    days = [DAY0 + timedelta(days=i) for i in range(-70, 140)]
    left = spark.createDataFrame(
        [*[(i, "a", d) for i, d in enumerate(days)], (-1, "a", None)], "id int, who string, day date"
    )
    at = datetime(2024, 3, 1, 9)
    right = spark.createDataFrame([("a", at, 3), ("a", at, 5), ("a", at, -4)], "who string, at timestamp_ntz, gap int")
    got = {r.id: r.matched_gap for r in first_match(left, right, "who", "day", "at", "gap").collect()}
    want = {i: min((g for g in (-4, 3, 5) if g <= (at.date() - d).days <= g + 7), default=None) for i, d in enumerate(days)}
    assert got == {**want, -1: None}


def test_first_match_lists_few_events_twice_and_matches_at_the_edges_of_blocks(spark):
    slack, first = 7, date(1970, 1, 1) + timedelta(days=38 * 512)
    days = [first + timedelta(days=i) for i in range(-20, 20)]
    left = spark.createDataFrame([(i, "a", d) for i, d in enumerate(days)], "id int, who string, day date")
    events = [("a", datetime.combine(first, datetime.min.time()) + timedelta(days=d, hours=d % 5), 2) for d in (-9, -3, 4, 11)]
    right = spark.createDataFrame(events, "who string, at timestamp_ntz, gap int")
    got = {r.id: r.matched_at for r in first_match(left, right, "who", "day", "at", "gap").collect()}
    fits = lambda d: [at for _, at, gap in events if gap <= (at.date() - d).days <= gap + slack]
    assert got == {i: min(fits(d), default=None) for i, d in enumerate(days)}
    start = datetime(2024, 1, 1)
    many = [(f"p{i % 50}", start + timedelta(days=i % 2000), 0) for i in range(20_000)]
    right = spark.createDataFrame(many, "who string, at timestamp_ntz, gap int").hint("merge")
    joined = first_match(left, right, "who", "day", "at", "gap")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().executedPlan()
    if plan.nodeName() == "ResultQueryStage":
        plan = plan.plan()
    stages = plan.collectLeaves()
    rows = [stages.apply(i).plan().metrics().apply("shuffleRecordsWritten").value() for i in range(stages.size())]
    assert max(rows) <= 20_000 * 21 // 20


def test_milestones_and_breach_limits(spark):
    rows = [(1, date(2024, 1, 2), date(2024, 2, 13)), (1, date(2024, 1, 1), None), (2, None, date(2024, 1, 1))]
    df = spark.createDataFrame(rows, "k int, a date, b date")
    firsts = milestones(df, "k", "a", {"x": "a", "y": "b"}).collect()
    assert [tuple(r) for r in firsts] == [(1, date(2024, 1, 1), date(2024, 2, 13))]
    spans = [(date(2024, 1, 1), date(2024, 1, 1) + timedelta(days=d)) for d in (42, 43, 126, 127)]
    spans.append((date(2024, 1, 1), None))
    df = spark.createDataFrame(spans, "a date, b date")
    flags = lambda limit: [r.f for r in interval_breach(df, "a", "b", limit, "w", "f").collect()]
    assert flags(42) == [False, True, True, True, False]
    assert flags(126) == [False, False, False, True, False]


def test_stage_minutes(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 59), datetime(2024, 1, 1, 4, 1, 0), None)],
        "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz",
    )
    row = stage_minutes(df, "a", {"m": "b", "n": "c"}).first()
    assert (row.m, row.n) == (241, None)


def test_status_flags(spark):
    df = spark.createDataFrame([("DNA",), ("cancelled_by_site",), ("Cancelled",), (None,)], "s string")
    rows = df.select(
        status_flag(F.col("s"), "DNA").alias("a"),
        contains_flag(F.col("s"), "cancel").alias("b"),
        status_flag(F.col("s"), "cancelled", ignore_case=True).alias("c"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (True, False, False), (False, True, False), (False, False, True), (False, False, False),
    ]


def test_quantiles_of_a_hot_group(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(9)}", rng.randrange(60)) for _ in range(4000)]
    rows += [("none", None)] * 3
    groups = defaultdict(list)
    for g, v in rows:
        groups[g] += [v] if v is not None else []
    df = spark.createDataFrame(rows, "g string, v int")
    got = {r.g: (r.a, r.b) for r in quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.9}).collect()}
    for g, v in groups.items():
        if v:
            assert got[g] == pytest.approx((statistics.median(v), np.quantile(v, 0.9)))
    assert got["none"] == (None, None)


def _events(spark, n=3000):
    rng = random.Random(11)
    rows = [
        (date(2024, 1 + rng.randrange(2), 1), rng.choice([1, 2, 3, 10, None]), rng.choice(["a", "b"]), rng.randrange(30), rng.random() < 0.3)
        for _ in range(n)
    ]
    rows += [(date(2024, 3, 1), 4, "a", 1, True)] * 4
    return rows, spark.createDataFrame(rows, "month date, imd_decile int, band string, wait int, hit boolean")


def test_stratified_metrics_against_brute_force(spark):
    rows, df = _events(spark)
    cells = defaultdict(list)
    for m, d, b, w, h in rows:
        cells[(m, "imd_decile", None if d is None else str(d))].append((w, h))
        cells[(m, "band", b)].append((w, h))
    medians = stratified_median(df, "x", "month", "wait", ["imd_decile", "band"])
    got = {(r.period, r.stratifier, r.stratum): (r.population_count, r.metric_value) for r in medians.collect()}
    assert got == {k: (len(v), statistics.median(w for w, _ in v)) for k, v in cells.items()}
    rates = stratified_rate(df, "x", "month", F.col("hit"), ["imd_decile", "band"])
    got = {(r.period, r.stratifier, r.stratum): r.metric_value for r in rates.collect()}
    assert got == {k: pytest.approx(sum(h for _, h in v) / len(v)) for k, v in cells.items()}


def test_ridit_and_slopes(spark):
    _, df = _events(spark)
    base = stratified_rate(df, "x", "month", F.col("hit"), ["imd_decile", "band"])
    for method in ("reference", "wls"):
        out = with_slope_indices(with_ridit(base), method).collect()
        for month in {r.period for r in out}:
            rows = [r for r in out if r.period == month and r.stratifier == "imd_decile"]
            rows.sort(key=lambda r: (r.stratum is None, int(r.stratum or 0)))
            n = np.array([r.population_count for r in rows], float)
            y = np.array([r.metric_value for r in rows])
            x = (np.cumsum(n) - n / 2) / n.sum()
            w = n / n.sum()
            assert [r.ridit_score for r in rows] == pytest.approx(list(x))
            assert all(0 < r.ridit_score < 1 for r in rows)
            assert sum(r.weight for r in rows) == pytest.approx(1)
            if len(rows) == 1 and method == "wls":
                assert rows[0].sii_value is None or abs(rows[0].sii_value) < 1e9
                continue
            if method == "wls":
                slope = np.polyfit(x, y, 1, w=np.sqrt(w))[0]
            else:
                k = len(rows)
                slope = (k * (w * x * y).sum() - (w * x).sum() * (w * y).sum()) / (
                    k * (w * x * x).sum() - (w * x).sum() ** 2
                ) if k > 1 else None
            if slope is not None:
                assert rows[0].sii_value == pytest.approx(slope)
                assert rows[0].rii_value == pytest.approx(slope / ((n * y).sum() / n.sum()))
        assert all(r.sii_value is None and r.ridit_score is None for r in out if r.stratifier == "band")


def test_one_stratum_has_no_slope(spark):
    df = spark.createDataFrame(
        [("m", DAY0, "imd_decile", "1", 10, 2.0), ("m", None, "imd_decile", "1", 10, 2.0)],
        "metric_name string, period date, stratifier string, stratum string, population_count bigint, metric_value double",
    )
    rows = with_slope_indices(with_ridit(df)).collect()
    assert [r.sii_value for r in rows] == [None, None]


def test_slope_sign_can_be_turned(spark):
    df = spark.createDataFrame(
        [("m", DAY0, "imd_decile", str(i), 10, float(i)) for i in range(1, 11)],
        "metric_name string, period date, stratifier string, stratum string, population_count bigint, metric_value double",
    )
    up = with_slope_indices(with_ridit(df), "wls").first().sii_value
    down = with_slope_indices(with_ridit(df), "wls", affluence_positive=False).first().sii_value
    assert up > 0 and down == -up
    with pytest.raises(ValueError):
        with_slope_indices(with_ridit(df), "other")


def test_small_cells_are_hidden(spark):
    df = spark.createDataFrame([(4, 1.0, 0.5), (5, 1.0, 0.5)], "population_count int, metric_value double, ridit_score double")
    rows = [tuple(r) for r in suppress_small(df, ["population_count", "metric_value"]).collect()]
    assert rows == [(None, None, 0.5), (5, 1.0, 0.5)]
    rows = [tuple(r) for r in suppress_small(df, ["population_count", "metric_value", "ridit_score"]).collect()]
    assert rows[0] == (None, None, None)


def test_report_shaping(spark):
    df = spark.createDataFrame(
        [("m", "1", 2.0), ("m", "2", 4.0), ("m", "3", None), ("flat", "1", 7.0), ("flat", "2", 7.0)],
        "metric_name string, stratum string, metric_value double",
    )
    scaled = {(r.metric_name, r.stratum): r.normalized for r in reports.scaled_within(df).collect()}
    assert scaled == {("m", "1"): 0.0, ("m", "2"): 1.0, ("flat", "1"): 0.5, ("flat", "2"): 0.5}
    gaps = reports.deviation_from_mean(df.where("metric_name = 'm'")).collect()
    assert {r.stratum: r.deviation for r in gaps} == {"1": -1.0, "2": 1.0}
    marks = {r.stratum: (r.suppressed, r.bar_value) for r in reports.suppression_marks(df.where("metric_name='m'")).collect()}
    assert marks == {"1": (False, 2.0), "2": (False, 4.0), "3": (True, 0.0)}
    rates = spark.createDataFrame([(0.25,), (None,), (float("nan"),)], "x double")
    assert [r.x for r in reports.as_percent(rates, "x").collect()] == [25.0, 0.0, 0.0]
    assert reports.hour_labels([0, 11, 23]) == ["00:00", "11:00", "23:00"]
    assert reports.hour_labels([1, 2, 10]) == ["1", "2", "10"]
    with pytest.raises(ValueError):
        reports.urgent_equity(reports.Gold(), "Shoe size")
    with pytest.raises(ValueError):
        reports.strata_of(reports.Gold(), "shoe_size")
