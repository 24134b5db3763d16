from __future__ import annotations

from datetime import date, datetime

import pytest

from waitlens.operators import quality
from waitlens.contracts import ENTITIES, SILVER_AGE_BANDS
from waitlens.operators import profiling, readiness
from waitlens.operators.quality import (
    QualityGateError,
    accepted_values,
    between,
    distinct_in_set,
    freshness,
    gate_status,
    not_null,
    require_gate,
    row_count,
    run_checks,
    run_suites,
    summarise_runs,
    unique,
)

TODAY = date(2024, 6, 1)


def verdicts(df, *checks):
    return {(r.check_name, r.column_name): (r.failed, r.passed) for r in run_checks(df, "t", checks).collect()}


def test_each_check(spark):
    rows = [(1, "a", 5), (2, "b", None), (2, None, 50), (None, "a", 7), (None, "a", 7)]
    df = spark.createDataFrame(rows, "k int, s string, n int")
    got = verdicts(
        df,
        not_null("k"),
        not_null("s", mostly=0.8),
        not_null("n", where="s = 'a'"),
        accepted_values("s", ["a", "b"]),
        between("n", 1, 40),
        between("n", low=6, where="k IS NULL"),
        row_count(1, 4),
        unique("k"),
        unique("k", "s"),
        distinct_in_set("s", ["a"]),
    )
    assert got == {
        ("not_null", "k"): (2, False),
        ("not_null", "s"): (1, True),
        ("not_null", "n"): (0, True),
        ("accepted_values", "s"): (0, True),
        ("between", "n"): (0, True),
        ("row_count", ""): (0, False),
        ("unique", "k"): (1, False),
        ("compound_unique", "k,s"): (1, False),
        ("distinct_in_set", "s"): (1, False),
    }
    assert verdicts(df, between("n", 1, 40)) == {("between", "n"): (1, False)}
    assert verdicts(df, accepted_values("s", SILVER_AGE_BANDS))[("accepted_values", "s")] == (4, False)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k int")
    got = verdicts(df, not_null("k", mostly=0.8), row_count(0), row_count(1), unique("k"))
    assert got[("not_null", "k")] == (0, True) and got[("unique", "k")] == (0, True)
    assert not verdicts(df, row_count(1))[("row_count", "")][1]
    assert verdicts(df, row_count(0))[("row_count", "")][1]


def test_plain_checks_share_one_scan(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = run_checks(df, "t", [not_null("id"), between("id", 0, 9), row_count(1)])._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_warnings_do_not_fail_a_run(spark):
    df = spark.createDataFrame([(None,)], "k int")
    results = run_checks(df, "t", [not_null("k", severity="warn")])
    row = summarise_runs(results, "r", TODAY).first()
    assert (row.run_status, row.failure_count) == ("PASSED", 0) and "not_null" in row.details


def test_a_table_that_cannot_be_read_fails(spark):
    df = spark.createDataFrame([(1,)], "k int")
    runs = run_suites(
        spark, {"a": df, "b": df}, {"a": [not_null("k")], "b": [not_null("zzz")], "c": [row_count(1)]}, "r", TODAY
    )
    got = {r.table_name: (r.run_status, r.failure_count) for r in runs.collect()}
    assert got == {"a": ("PASSED", 0), "b": ("FAILED", -1), "c": ("FAILED", -1)}


def test_gate(spark):
    runs = spark.createDataFrame(
        [("a", TODAY, "PASSED"), ("b", TODAY, "FAILED"), ("a", date(2024, 5, 31), "PASSED")],
        "table_name string, run_date date, run_status string",
    )
    assert tuple(gate_status(runs, TODAY).first()) == (1, 2, True)
    with pytest.raises(QualityGateError, match="1 table"):
        require_gate(runs, TODAY)
    with pytest.raises(QualityGateError, match="no validation"):
        require_gate(runs, date(2024, 6, 2))
    require_gate(runs, date(2024, 5, 31))


@pytest.mark.parametrize("day,status", [(30, "ok"), (29, "warn"), (28, "error")])
def test_freshness(spark, day, status):
    df = spark.createDataFrame([(date(2024, 5, day),)], "ingest_date date")
    assert freshness(df, TODAY if status != "warn" else date(2024, 6, 1)).first().status == status


def test_freshness_of_nothing(spark):
    assert freshness(spark.createDataFrame([], "ingest_date date"), TODAY).first().status == "error"


AT = datetime(2024, 1, 5)


@pytest.fixture
def entities(spark):
    """A small sound set: text ids where text ids are usual."""
    make = spark.createDataFrame
    return {
        "patient_demographics": make([(1, AT), (2, AT)], "patient_id bigint, updated_at timestamp_ntz"),
        "encounters": make(
            [(10, 1, 5, 9, AT), (11, 2, 5, 9, AT)],
            "encounter_id bigint, patient_id bigint, provider_id bigint, clinician_id bigint, encounter_datetime_start timestamp_ntz",
        ),
        "referrals": make([(20, 1, 5, 5)], "referral_id bigint, patient_id bigint, source_provider_id bigint, target_provider_id bigint"),
        "diagnoses": make([(30, 1, 10)], "diagnosis_id bigint, patient_id bigint, encounter_id bigint"),
        "appointments": make([("A1", "1", "n")], "appointment_id string, patient_id string, nhs_pseudo_id string"),
        "urgent_care_logs": make(
            [(40, 1, 5, 10, AT)],
            "uc_log_id bigint, patient_id bigint, provider_id bigint, encounter_id bigint, arrival_datetime timestamp_ntz",
        ),
        "diagnostics_orders": make([("D1", "1", "20", "10", "5")], "diagnostic_id string, patient_id string, referral_id string, encounter_id string, provider_id string"),
        "provider_site_reference": make([(5, "P5")], "provider_id bigint, provider_code string"),
    }


def rows(df):
    return {(r.check_name, r.entity): r.passed for r in df.collect()}


def test_sound_entities_are_ready(spark, entities):
    report = readiness.readiness_report(spark, entities)
    bad = [tuple(r) for r in report.where("NOT passed").collect()]
    # Text keys next to whole numbers: the whole-number holders are reported, as documented.
    assert {b[0] for b in bad} == {"type_consistency"}
    verdict = readiness.readiness_verdict(report.where("check_name <> 'type_consistency'")).first()
    assert verdict.ready and verdict.failed == 0


def test_broken_entities_are_found(spark, entities):
    make = spark.createDataFrame
    broken = dict(entities)
    del broken["diagnoses"]
    broken["referrals"] = make([], "referral_id bigint, patient_id bigint, source_provider_id bigint, target_provider_id bigint")
    assert rows(readiness.completeness(spark, broken))[("entity_completeness", "diagnoses")] is False
    assert rows(readiness.completeness(spark, broken))[("entity_completeness", "referrals")] is False
    assert ("pk_unique_nonnull", "referrals") not in rows(readiness.primary_keys(spark, broken))

    broken["patient_demographics"] = make([(1, AT), (1, AT), (None, AT), (None, AT)], "patient_id bigint, updated_at timestamp_ntz")
    detail = readiness.primary_keys(spark, broken).where("entity = 'patient_demographics'").first()
    assert (detail.passed, detail.detail) == (False, "nulls=2, duplicates=2, rows=4")
    found = readiness.null_rates(spark, broken).collect()
    assert [(r.entity, r.passed) for r in found] == [("patient_demographics", False)]

    broken["encounters"] = make([(10, 999, 5, 9, AT)], "encounter_id bigint, patient_id bigint, provider_id bigint, clinician_id bigint, encounter_datetime_start timestamp_ntz")
    orphan = readiness.references(spark, broken).where("entity = 'encounters' AND NOT passed").first()
    assert orphan.detail == "patient_id -> patient_demographics.patient_id: orphans=1/1"
    broken["encounters"] = broken["encounters"].drop("patient_id")
    assert any("column missing" in r.detail for r in readiness.references(spark, broken).collect())
    assert rows(readiness.join_keys_present(spark, broken))[("join_key_existence", "encounters")] is not None


def test_null_rate_warning(spark, entities):
    frames = {"patient_demographics": spark.createDataFrame([(1, None), (2, None), (3, "x")], "patient_id bigint, note string")}
    (row,) = readiness.null_rates(spark, frames).collect()
    assert row.passed and row.detail == "WARN column=note nulls=2"


def test_date_overlap(spark, entities):
    assert rows(readiness.date_overlap(spark, entities))[("date_range_coverage", "all")] is True
    few = {"patient_demographics": entities["patient_demographics"]}
    (row,) = readiness.date_overlap(spark, few).collect()
    assert (row.entity, row.passed) == ("all", False)
    (row,) = readiness.date_overlap(spark, {"appointments": entities["appointments"]}).collect()
    assert row.passed is False
    apart = dict(entities)
    apart["urgent_care_logs"] = spark.createDataFrame([(1, datetime(2030, 1, 1))], "uc_log_id bigint, arrival_datetime timestamp_ntz")
    assert rows(readiness.date_overlap(spark, apart))[("date_range_coverage", "all")] is False


def test_profiles_and_gaps(spark):
    data = [(1, "ann", 30), (2, "bob", None), (3, None, 40), (4, "ann", 50), (5, "cyd", 60)]
    df = spark.createDataFrame(data, "patient_id bigint, name string, age int")
    for approximate in (False, True):
        got = {r.column_name: r for r in profiling.column_profile(df, approximate).collect()}
        assert got["name"].non_null_pct == 80.0 and got["name"].distinct_count == 3
        assert got["name"].min_value is None and got["age"].max_value == "60"
    summary = profiling.entity_profile(df, "patient_demographics", "patient_id", "ehr")
    assert summary.first().pk_unique and summary.first().row_count == 5
    gaps = profiling.gap_rows(profiling.column_profile(df), summary, ENTITIES["patient_demographics"])
    assert {(r.gap, r.column_name) for r in gaps.collect()} == {
        ("high_nulls", "name"), ("high_nulls", "age"), ("join_keys", None),
    }


def test_gaps_of_a_bad_entity(spark):
    df = spark.createDataFrame([("D1", "2024-01-01"), ("D1", "x"), (None, "y")], "diagnostic_id string, request_date string")
    summary = profiling.entity_profile(df, "diagnostics_orders", "diagnostic_id", "trust")
    gaps = profiling.gap_rows(profiling.column_profile(df), summary, ENTITIES["diagnostics_orders"])
    kinds = {r.gap for r in gaps.collect()}
    assert kinds == {"type_mismatch", "high_nulls", "join_keys", "pk_duplicates", "pk_nulls"}
    empty = df.limit(0)
    summary = profiling.entity_profile(empty, "diagnostics_orders", "diagnostic_id", "trust")
    assert summary.first().row_count == 0
    gaps = profiling.gap_rows(profiling.column_profile(empty), summary, ENTITIES["diagnostics_orders"])
    assert "no_rows" in {r.gap for r in gaps.collect()}


def test_checks_taken_while_writing_equal_checks_read_afterwards(spark, tmp_path):
    rows = [(i % 40, None if i % 7 == 0 else i, "ab"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "k int, v int, s string")
    checks = [
        quality.row_count(1, 99), quality.not_null("v", mostly=0.8), quality.not_null("v", where="s = 'a'"), quality.unique("k"),
        quality.between("v", 3, 90, severity="warn"), quality.accepted_values("s", ["a"]), quality.distinct_in_set("s", ["a", "b"]),
    ]
    passing, seen = quality.watched(df, "t", checks)
    passing.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = seen()
    # Uniqueness alone: the written rows are read by the grouped checks only.
    plan = quality.run_checks(stored, "t", checks, found)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    want = sorted(map(str, quality.run_checks(df, "t", checks).collect()))
    assert sorted(map(str, quality.run_checks(stored, "t", checks, found).collect())) == want
    assert quality.watched(df, "t", [quality.unique("k")])[1]() is None


def test_columns_a_suite_reads_include_its_scopes():
    checks = [quality.row_count(1), quality.unique("a", "b"), quality.between("c", 0, 1, where="d > 0 AND e IS NOT NULL")]
    assert {"a", "b", "c", "d", "e"} <= quality.checked_columns(checks)
    assert quality.grouped_checks(checks) == [checks[1]]
