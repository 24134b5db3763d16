"""Streams, the daily run, and every registered query against its SQL."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import partial

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.compare import compare, connect
from waitlens.contracts import ENTITIES, GOLD_TABLES
from waitlens.operators.quality import QualityGateError, not_null, row_count
from waitlens.plans import daily, reports, silver
from waitlens.plans.suites import GOLD_SUITES
from waitlens.session import settle, settled_folder
from waitlens.sources import exports
from waitlens.sources.files import files
from waitlens.sources.manifests import read_manifests
from waitlens.sources.keyed import KeyedTable
from waitlens.streaming import incremental, monitor
from workload.checks import e9_declared
from workload.ingest import a16_whole
from workload.queries import REGISTRY
from workload.roles import TEST_KEY, Roles

SMALL = "/root/testdata/sf0.001"


def test_stream_loads_late_files_and_only_new_ones(spark, tmp_path):
    path, table = str(tmp_path / "in"), KeyedTable(spark, str(tmp_path / "t"))
    frame = lambda rows: spark.createDataFrame(rows, "k int, at int, v string")

    def load():
        new = incremental.read_new_files(spark, path, frame([]).schema)
        incremental.upsert_stream(new, table, ["k"], ["at"], ["v"], str(tmp_path / "c")).awaitTermination()
        return sorted(map(tuple, table.read().collect()))

    frame([(1, 5, "a"), (1, 6, "b"), (2, 1, "c")]).write.parquet(path)
    assert load() == [(1, 6, "b"), (2, 1, "c")]
    frame([(2, 0, "late"), (3, 1, "d"), (2, 2, "new")]).write.mode("append").parquet(path)
    assert load() == [(1, 6, "b"), (2, 2, "new"), (3, 1, "d")]
    frame([(2, 0, "later still")]).write.mode("append").parquet(path)
    assert load() == [(1, 6, "b"), (2, 2, "new"), (3, 1, "d")]
    loaded = table.loaded()
    assert len(loaded) == 3
    assert load() == [(1, 6, "b"), (2, 2, "new"), (3, 1, "d")]
    assert table.loaded() == loaded


def test_streamed_windows_equal_batch_windows(spark, tmp_path):
    path = str(tmp_path / "events")
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(minutes=i), "ok" if i % 3 else "failed") for i in range(60)]
    shape = "ts timestamp, event_type string"
    spark.createDataFrame(rows, shape).write.parquet(path)
    streamed = monitor.event_windows(spark.readStream.schema(shape).parquet(path), watermark="10 minutes")
    q = streamed.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = monitor.event_windows(spark.read.parquet(path))
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, batch.collect()))


def test_alarms(spark):
    start = datetime(2024, 1, 1)
    hours = [0, 1, 5, 9]
    rows = [(start + timedelta(hours=h, minutes=30), "done") for h in hours] + [(start, "other")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string")
    counted = monitor.event_windows(df, width="1 hour")
    assert monitor.threshold_alarm(counted, ["done"]).count() == 4
    assert monitor.threshold_alarm(counted, ["done"], 2).count() == 0
    assert monitor.threshold_alarm(counted, ["failed"]).count() == 0
    stale = monitor.staleness(df, periods=3, names=["done"]).where("stale").collect()
    assert sorted(r.hour.hour for r in stale) == [4, 8]
    late = monitor.staleness(
        df, periods=3, names=["done"], until=F.lit("2024-01-01 13:00:00").cast("timestamp_ntz")
    ).where("stale").collect()
    assert sorted(r.hour.hour for r in late) == [4, 8, 12, 13]


@pytest.fixture(scope="module")
def deliveries(spark):
    """The test tables as what the sources deliver."""
    bronze = Roles(spark, SMALL).bronze
    plain = {n: (lambda d=df.drop("ingest_date"): d) for n, df in bronze.items()}
    by_source: dict[str, dict] = {}
    for name, load in plain.items():
        by_source.setdefault(ENTITIES[name].source, {})[name] = load
    # The last source of the list depends on nothing; order does not matter.
    return by_source


def test_a_whole_day(spark, tmp_path, deliveries):
    paths, ctx = daily.Paths(str(tmp_path / "lake")), silver.Context(TEST_KEY)
    day = date(2024, 6, 1)
    # More than a fifth of these patients have an unusable number, so the standard gate holds.
    with pytest.raises(QualityGateError, match="2 table"):
        daily.run_day(spark, paths, deliveries, ctx, day, mode="snapshot")
    assert exports.list_exports(spark, paths.exports) == []
    lenient = daily.GATE_SUITES | {
        t: [row_count(1), not_null("patient_sk", mostly=0.6)] for t in ("encounters", "referrals")
    }
    # Some of these patients have no sex, so one stratum has no name.
    with pytest.raises(QualityGateError, match="1 table"):
        daily.run_day(spark, paths, deliveries, ctx, day, mode="snapshot", suites=lenient)
    assert exports.list_exports(spark, paths.exports) == []
    # A failed Silver test blocks as well, and is told apart.
    broken = {"encounters": [not_null("patient_sk")]}
    with pytest.raises(QualityGateError, match="1 table"):
        daily.run_day(spark, paths, deliveries, ctx, day, mode="snapshot", suites=lenient, silver_suites=broken)
    runs = {r.table_name: r.run_status for r in exports.read_runs(spark, f"{paths.quality}_silver").collect()}
    assert runs == {"encounters": "FAILED"}
    ages = spark.read.parquet(paths.freshness).collect()
    assert len(ages) == 8 and {(r.age_days, r.status) for r in ages} == {(0, "ok")}
    named = GOLD_SUITES | {"fct_inequality": [row_count(1)]}
    run = partial(daily.run_day, spark, paths, deliveries, ctx, suites=lenient, gold_suites=named)
    assert run(day, mode="snapshot") == day
    assert {r.status for r in read_manifests(spark, paths.manifests).collect()} == {"success"}
    tables = {t: exports.read_export(spark, paths.exports, t) for t in GOLD_TABLES}
    r = Roles(spark, SMALL)
    assert tables["fct_wait_times"].count() == r.s_referrals.count()
    assert tables["fct_urgent_care"].count() == 1000
    assert tables["fct_inequality"].where("population_count < 5").count() == 0
    keys = ["metric_name", "period", "stratifier", "stratum"]
    assert tables["fct_inequality"].groupBy(*keys).count().where("count > 1").count() == 0
    gold = reports.Gold(urgent=tables["fct_urgent_care"], sites=tables["dim_site"])
    assert reports.urgent_kpis(gold).first().breach_rate_4h > 0
    vault = KeyedTable(spark, paths.silver("patient_identifiers")).read()
    quarantine = KeyedTable(spark, paths.silver("patients_quarantine")).read()
    assert quarantine.where("rejection_reason IS NULL").count() == 0
    assert vault.where("patient_sk IS NULL").count() == 0

    before = KeyedTable(spark, paths.silver("encounters")).read().count()
    assert run(day, mode="snapshot") == day
    assert KeyedTable(spark, paths.silver("encounters")).read().count() == before
    assert exports.list_exports(spark, paths.exports) == [day.isoformat()]

    assert run() == day + timedelta(days=1)


def test_stale_or_unready_bronze_stops_the_run(spark, tmp_path):
    paths = daily.Paths(str(tmp_path / "lake"))
    rows = spark.createDataFrame([], ENTITIES["encounters"].schema()).drop("ingest_date")
    sources = {"ehr_postgres": {"encounters": lambda: rows}}
    with pytest.raises(QualityGateError, match="no recent partition of encounters"):
        daily.run_day(spark, paths, sources, silver.Context(b"k"), date(2024, 1, 1), mode="snapshot")
    one = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    sources = {"ehr_postgres": {"encounters": lambda: one}}
    with pytest.raises(QualityGateError, match="not ready on 2024-01-02"):
        daily.run_day(spark, paths, sources, silver.Context(b"k"), date(2024, 1, 2), mode="snapshot", readiness="block")
    assert spark.read.parquet(paths.readiness).where("NOT passed").count() > 0
    with pytest.raises(ValueError, match="unknown readiness"):
        daily.run_day(spark, paths, sources, silver.Context(b"k"), date(2024, 1, 2), readiness="maybe")


def test_a_failed_table_fails_the_run(spark, tmp_path):
    paths = daily.Paths(str(tmp_path / "lake"))

    def broken():
        return spark.read.parquet(str(tmp_path / "nowhere"))

    sources = {"ehr_postgres": {"encounters": broken, "referrals": broken}}
    with pytest.raises(RuntimeError, match="ehr_postgres"):
        daily.run_day(spark, paths, sources, silver.Context(b"k"), date(2024, 1, 1))
    (row,) = read_manifests(spark, paths.manifests).collect()
    assert row.status == "failed" and len(row.error) == 1
    assert daily.ingest_source(
        spark, paths, "ehr_postgres", sources["ehr_postgres"], date(2024, 1, 1), fail_fast=False
    ) == "failed"
    assert max(len(r.error) for r in read_manifests(spark, paths.manifests).collect()) == 2
    with pytest.raises(ValueError, match="name the run date"):
        daily.run_day(spark, paths, sources, silver.Context(b"k"))


def test_a_source_with_nothing_to_land_is_skipped(spark, tmp_path):
    paths = daily.Paths(str(tmp_path / "lake"), env="test")
    done = daily.ingest_source(spark, paths, "sftp", {"appointments": lambda: None}, date(2024, 1, 1))
    assert done == "skipped"
    (row,) = read_manifests(spark, paths.manifests).collect()
    assert row.status == "skipped" and row.reason == "nothing to land"


def test_a_file_drop_lands_with_its_digests(spark, tmp_path):
    import hashlib

    paths, root = daily.Paths(str(tmp_path / "lake")), tmp_path / "drop"
    folder = root / "export_date=20240105"
    folder.mkdir(parents=True)
    kinds = {f.name: f.dataType.simpleString() for f in ENTITIES["appointments"].schema()}
    whole = next((c for c, k in kinds.items() if k == "bigint"), None)
    bodies = {f"{n}.csv": f"appointment_id,{whole or 'booking_status'}\nA{n},{n}\nB{n},x\n" for n in range(2)}
    for name, body in bodies.items():
        (folder / name).write_text(body)
    load = daily.file_drop(spark, paths, "appointments", str(root), date(2024, 1, 5))
    assert daily.ingest_source(spark, paths, "sftp_appointments", {"appointments": load}, date(2024, 1, 5)) == "success"
    stored = {r.file_name: (r.bytes, r.sha256) for r in spark.read.parquet(f"{paths.files}/appointments").collect()}
    assert stored == {n: (len(b), hashlib.sha256(b.encode()).hexdigest()) for n, b in bodies.items()}
    from waitlens.sources.lake import read_bronze

    rows = read_bronze(spark, paths.lake, ENTITIES["appointments"]).collect()
    assert sorted(r.appointment_id for r in rows) == ["A0", "A1", "B0", "B1"]
    # Another day brought no files.
    load = daily.file_drop(spark, paths, "appointments", str(root), date(2024, 1, 6))
    assert daily.ingest_source(spark, paths, "sftp_appointments", {"appointments": load}, date(2024, 1, 6)) == "skipped"


def test_settled_tables_go_with_their_run(spark, tmp_path):
    with settled_folder(spark) as folder:
        df = settle(spark.range(3))
        assert df.count() == 3 and len(files(spark, folder)) == 1
    assert files(spark, folder) == []


def test_the_gate_blocks_promotion(spark, tmp_path):
    paths = daily.Paths(str(tmp_path / "lake"))
    keys = [(i, "x" if i < 7 else None) for i in range(10)]
    silver_tables = {
        "patients": spark.createDataFrame([("a", "M")], "patient_sk string, sex string"),
        "encounters": spark.createDataFrame(keys, "encounter_id int, patient_sk string"),
        "referrals": spark.createDataFrame(keys[:8], "referral_id int, patient_sk string"),
        "diagnoses": spark.createDataFrame([], "diagnosis_id int"),
    }
    with pytest.raises(QualityGateError, match="1 table"):
        daily.validate(spark, paths, silver_tables, date(2024, 1, 1))
    status = {r.table_name: r.run_status for r in exports.read_runs(spark, paths.quality).collect()}
    assert status == {"patients": "PASSED", "encounters": "FAILED", "referrals": "PASSED", "diagnoses": "PASSED"}


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_registered_query(spark, oracle, name):
    df = contract.queries()[name](spark, SMALL)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, oracle, sql) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_whole_export_makes_later_tables_from_exported_ones(spark):
    r = Roles(spark, SMALL)
    told = {x.table_name: x.n for x in a16_whole(r).collect()}
    assert len(told) == 10 and told["fct_wait_times"] == r.waits.count()
    for table in (r.waits, r.urgent, r.dim_patient):
        assert all("table=" in f for f in table.inputFiles())


def test_declared_checks_make_each_table_once_and_keep_what_is_needed(spark):
    r = Roles(spark, SMALL)
    e9_declared(r)
    assert set(r.s_diagnostics.columns) == {"diagnostic_id", "referral_id", "request_date", "result_date"}
    assert r.utilisation.columns == ["appointment_id"]
    for table in (r.s_encounters, r.waits, r.urgent, r.inequality):
        assert all("settled-" in f for f in table.inputFiles())


def test_metrics_read_only_what_they_need_of_the_facts(spark):
    r = Roles(spark, SMALL)
    waits, urgent, _, _ = r.inequality_facts
    for narrow, fact, required in ((waits, r.waits, "wait_days"), (urgent, r.urgent, "patient_sk")):
        full = fact.select(*narrow.columns)
        assert narrow.schema == full.schema
        assert narrow.exceptAll(full).isEmpty() and full.exceptAll(narrow).isEmpty()
        assert not narrow.where(f"{required} IS NOT NULL").isEmpty()
    metrics = contract.queries()["d9_stratified_metrics"](spark, SMALL)
    plan = metrics._jdf.queryExecution().optimizedPlan().toString()
    # Lines are read for encounters only; no test, site or specialty is.
    assert plan.count("Relation [l_orderkey") == 1
    assert all(c not in plan for c in ("DX-", "s_suppkey", "site_sk", "specialty_sk"))


def test_metrics_read_a_fact_that_was_made(spark):
    r = Roles(spark, SMALL)
    r.waits, r.urgent = settle(r.waits), settle(r.urgent)
    assert r.inequality_facts[:2] == (r.waits, r.urgent)


def test_wait_fact_moves_referrals_by_their_id_once(spark):
    stored, fresh = Roles(spark, SMALL), Roles(spark, SMALL)
    stored.s_referrals = settle(stored.s_referrals)
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fresh.waits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
    # One shuffle for the latest referrals, one for the tests of each; none for their join.
    assert plan.count("Exchange hashpartitioning(referral_id#") == 2
    assert fresh.waits.schema == stored.waits.schema
    assert fresh.waits.exceptAll(stored.waits).isEmpty() and stored.waits.exceptAll(fresh.waits).isEmpty()
    assert not fresh.waits.where("dm01_wait_days IS NOT NULL").isEmpty()


def test_referrals_take_columns_along_without_losing_rows(spark):
    r = Roles(spark, SMALL)
    beside = spark.createDataFrame([(1, "one"), (-5, "nobody's")], "referral_id bigint, note string")
    got = silver.referrals(r.referrals, r.vault, r.ctx, beside)
    assert got.columns == [*r.s_referrals.columns, "note"]
    assert got.drop("note").exceptAll(r.s_referrals).isEmpty() and got.count() == r.s_referrals.count()
    assert [x.referral_id for x in got.where("note IS NOT NULL").collect()] == [1]
