from __future__ import annotations

import hashlib
import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from waitlens.contracts import BACKFILL_TYPES, ENTITIES, GOLD_TABLES
from waitlens.sources import drops, exports, lake, manifests
from waitlens.sources.seeds import SEEDS, area_deprivation, load_seed


def test_business_date_slice_reaches_the_scan(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1 + i % 3, i % 24)) for i in range(48)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "i int, at timestamp_ntz").write.parquet(path)
    df = lake.slice_by_date(spark.read.parquet(path), "at", date(2024, 1, 2))
    assert {r.i for r in df.collect()} == {i for i, at in rows if at.day == 2}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan.split("PushedFilters")[1]


def test_bronze_round_trip_prunes_dates(spark, tmp_path):
    entity = ENTITIES["diagnoses"]
    shape = entity.schema()
    rows = [{f.name: None for f in shape} | {"diagnosis_id": i, "ingest_date": date(2024, 1, 1 + i % 4)} for i in range(20)]
    lake.write_bronze(spark.createDataFrame(rows, shape), str(tmp_path), entity)
    assert (tmp_path / "bronze/source=ehr_postgres/entity=diagnoses/ingest_date=2024-01-03").is_dir()
    df = lake.read_bronze(spark, str(tmp_path), entity, [date(2024, 1, 2)])
    assert {r.diagnosis_id for r in df.collect()} == {1, 5, 9, 13, 17}
    assert "PartitionFilters: [isnotnull(ingest_date" in df._jdf.queryExecution().executedPlan().toString()
    assert lake.read_bronze(spark, str(tmp_path), ENTITIES["referrals"]).count() == 0
    listed = lake.listed_partitions(spark, str(tmp_path))
    assert {(r.entity, r.ingest_date.day) for r in listed.collect()} == {("diagnoses", d) for d in (1, 2, 3, 4)}


def test_writing_a_date_again_replaces_only_that_date(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "x int, ingest_date date")
    lake.write_partitions(frame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))]), path)
    lake.write_partitions(frame([(3, date(2024, 1, 2))]), path)
    assert {(r.x, r.ingest_date.day) for r in spark.read.parquet(path).collect()} == {(1, 1), (3, 2)}


def test_backfill_clamps_and_rejects(spark):
    rows = [(1, date(1990, 1, 1)), (2, date(2020, 1, 1)), (3, date(2026, 1, 1)), (4, None)]
    df = spark.createDataFrame(rows, "i int, registered date")
    dated, rejected = lake.backfill(df, "registered", date(2025, 6, 3))
    assert {(r.i, r.ingest_date) for r in dated.collect()} == {
        (1, date(2025, 6, 3)), (2, date(2025, 6, 3)), (3, date(2026, 1, 1)),
    }
    assert [r.i for r in rejected.collect()] == [4]


def test_backfill_by_file_name(spark, tmp_path):
    for name, body in {
        "20260115_appointments.csv": "id,v\n1,a\n",
        "20200220_appointments.csv": "id,v\n2,b\n",
        "undated0_appointments.csv": "id,v\n3,c\n",
        "20261399_appointments.csv": "id,v\n4,d\n",
        "20260116_appointments.csv": "id,v\n",
    }.items():
        (tmp_path / name).write_text(body)
    dated, rejected = lake.backfill_by_file_name(drops.land_csv(spark, str(tmp_path)), date(2025, 6, 3))
    assert {r.id for r in rejected.collect()} == {"3", "4"}
    assert {(r.id, r.ingest_date) for r in dated.collect()} == {("1", date(2026, 1, 15)), ("2", date(2025, 6, 3))}
    assert "file_name" not in dated.columns


def test_land_csv_keeps_text(spark, tmp_path):
    body = 'id,note,empty\n1,"a, ""quoted""\nline",\n2,nan,\n'.encode() + b"3,bad \xff byte,x\n"
    (tmp_path / "one.CSV").write_bytes(body)
    (tmp_path / "ignored.txt").write_text("not,a,csv\n")
    rows = {r.id: r for r in drops.land_csv(spark, str(tmp_path), multi_line=True).collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].note == 'a, "quoted"\nline' and rows["1"].empty == ""
    assert rows["2"].note == "nan" and rows["3"].note == "bad � byte"
    assert rows["1"].file_name == "one.CSV"
    nulls = {r.id: r.empty for r in drops.land_csv(spark, str(tmp_path), empty_as_null=True, multi_line=True).collect()}
    assert nulls == {"1": None, "2": None, "3": "x"}


def test_land_csv_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n")
    df = drops.land_csv(spark, str(tmp_path))
    assert df.columns == ["id", "v", "file_name"] and df.count() == 0


def test_land_csv_refuses_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,a\n")
    (tmp_path / "b.csv").write_text("v,id\nb,2\n")
    with pytest.raises(Exception, match="header"):
        drops.land_csv(spark, str(tmp_path)).collect()


def test_land_mixed_csv_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,a\n")
    (tmp_path / "b.csv").write_text("v,id\nb,2\n")
    (tmp_path / "c.csv").write_text("id,extra\n3,x\n")
    (tmp_path / "d.csv").write_text("")
    (tmp_path / "note.txt").write_text("no csv")
    rows = {r.id: (r.v, r.extra, r.file_name) for r in drops.land_mixed_csv(spark, str(tmp_path)).collect()}
    assert rows == {"1": ("a", None, "a.csv"), "2": ("b", None, "b.csv"), "3": (None, "x", "c.csv")}
    (tmp_path / "empty").mkdir()
    assert drops.land_mixed_csv(spark, str(tmp_path / "empty")) is None


def test_land_csv_split_reading(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,nan\n2,\n")
    rows = drops.land_csv(spark, str(tmp_path), ["id", "v"], multi_line=False).collect()
    assert {(r.id, r.v) for r in rows} == {("1", "nan"), ("2", "")}


def test_exports_are_found_and_landed(spark, tmp_path):
    root = tmp_path / "orders"
    assert drops.export_dates(spark, str(root)) == []
    assert drops.land_exports(spark, str(root)) is None
    for day in ("20260512", "20260501"):
        (root / f"export_date={day}").mkdir(parents=True)
        (root / f"export_date={day}" / "orders.csv").write_text(f"id,value\n{day[-1]},a\n")
    (root / "export_date=20260512" / "readme.txt").write_text("id,value\n9,z\n")
    (root / "export_date=soon").mkdir()
    assert drops.export_dates(spark, str(root)) == [date(2026, 5, 1), date(2026, 5, 12)]
    landed = drops.land_exports(spark, str(root))
    assert {(r.id, r.ingest_date.day) for r in landed.collect()} == {("1", 1), ("2", 12)}
    assert drops.land_exports(spark, str(root), date(2026, 5, 12)).count() == 1
    assert drops.land_exports(spark, str(root), date(2026, 5, 13)) is None


def test_inventory(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    (row,) = drops.inventory(spark, str(tmp_path)).collect()
    assert tuple(row) == ("a.bin", 5, hashlib.sha256(b"hello").hexdigest())


def test_coerce(spark):
    df = spark.createDataFrame([("1", "2024-01-01 10:00:00", "true"), ("x", "soon", "maybe")], "n string, t string, b string")
    now = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    types = {"n": "int64", "t": "timestamp", "b": "bool", "absent": "timestamp", "absent_too": "int64"}
    rows = [tuple(r) for r in lake.coerce(df, types, now=now).collect()]
    stamp = datetime(2024, 6, 1)
    assert rows == [(1, datetime(2024, 1, 1, 10), True, stamp), (None, None, None, stamp)]
    assert BACKFILL_TYPES["patient_demographics"]["nhs_pseudo_id"] == "str"
    assert BACKFILL_TYPES["encounters"]["was_attended"] == "bool"


def test_missing_partitions(spark):
    present = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 1, 2))], "entity string, ingest_date date")
    got = lake.missing_partitions(present, ["a", "b"], date(2024, 1, 1), date(2024, 1, 2)).collect()
    assert {(r.entity, r.ingest_date.day) for r in got} == {("a", 2), ("b", 1)}


def test_seeds(spark):
    sizes = {n: load_seed(spark, n).count() for n in SEEDS}
    assert sizes == {"ethnicity": 17, "icd10": 21, "imd": 10, "lsoa_imd": 82}
    assert area_deprivation(spark).where("imd_label IS NULL").count() == 0
    with pytest.raises(ValueError):
        load_seed(spark, "other")


def test_seed_joins_broadcast_by_themselves(spark):
    df = spark.range(10).select(F.col("id").cast("int").alias("imd_decile"))
    plan = df.join(load_seed(spark, "imd"), "imd_decile", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def _results(spark, items):
    return spark.createDataFrame(
        items, "source string, ingest_date date, run_id string, item string, status string, error string"
    )


def test_manifests(spark, tmp_path):
    day, root = date(2024, 1, 1), str(tmp_path / "m")
    assert manifests.read_manifests(spark, root).count() == 0
    assert not manifests.already_done(manifests.read_manifests(spark, root), "ehr", day)
    built = manifests.build_manifests(
        _results(spark, [("ehr", day, "r1", "a", "success", None), ("ehr", day, "r1", "b", "failed", "boom")])
    )
    row = built.first()
    assert (row.status, row.error, row.items_succeeded, row.items_failed) == ("failed", ["boom"], 1, 1)
    manifests.write_manifests(built, root)
    assert not manifests.already_done(manifests.read_manifests(spark, root), "ehr", day)
    done = manifests.build_manifests(_results(spark, [("ehr", day, "r2", "a", "success", None)]))
    manifests.write_manifests(done, root)
    for path in (tmp_path / "m").rglob("*.json"):
        newer = "r2" in path.read_text()
        os.utime(path, (2_000_000_000 if newer else 1_000_000_000,) * 2)
    assert manifests.already_done(manifests.read_manifests(spark, root), "ehr", day)
    assert not manifests.already_done(manifests.read_manifests(spark, root), "ehr_extra", day)
    assert manifests.next_business_date(manifests.read_manifests(spark, root)).first().next_date == date(2024, 1, 2)


@pytest.mark.parametrize("body,skip", [
    ('{"status": "success"}', True),
    ('{"status": "failed"}', False),
    ('{"status": "skipped"}', False),
    ("not json", False),
    ("[1, 2]", False),
    ('{"other": 1}', False),
])
def test_newest_manifest_decides(spark, tmp_path, body, skip):
    folder = tmp_path / "m/source=ehr/ingest_date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "old.json").write_text(json.dumps({"run_id": "0", "status": "failed" if skip else "success"}))
    (folder / "new.json").write_text(body)
    os.utime(folder / "old.json", (1_000_000_000,) * 2)
    found = manifests.read_manifests(spark, str(tmp_path / "m"))
    assert manifests.already_done(found, "ehr", date(2024, 1, 1)) is skip


def test_next_date_waits_for_the_slowest_source(spark):
    rows = [
        ("a", date(2024, 1, 5), "1", "success", datetime(2024, 1, 5)),
        ("b", date(2024, 1, 3), "1", "success", datetime(2024, 1, 3)),
        ("b", date(2024, 1, 4), "2", "success", datetime(2024, 1, 4)),
        ("b", date(2024, 1, 4), "3", "failed", datetime(2024, 1, 4, 1)),
        ("c", date(2024, 1, 1), "1", "failed", datetime(2024, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "source string, ingest_date date, run_id string, status string, modified_at timestamp_ntz")
    assert {(r.source, r.latest.day) for r in manifests.latest_success(df).collect()} == {("a", 5), ("b", 3)}
    assert manifests.next_business_date(df).first().next_date == date(2024, 1, 4)
    assert manifests.next_business_date(df.where("source = 'c'")).first().next_date is None


def test_an_export_is_written_where_its_rows_lie(spark, tmp_path):
    exports.export_gold({"dim_imd": spark.range(0, 1000, 1, 3).toDF("imd_decile")}, str(tmp_path / "gold"), "2024-01-01")
    assert exports.read_export(spark, str(tmp_path / "gold"), "dim_imd").count() == 1000
    assert len(list((tmp_path / "gold").rglob("*.parquet"))) == 3


def test_exports(spark, tmp_path):
    root = str(tmp_path / "gold")
    frame = lambda n: spark.range(n).withColumnRenamed("id", "imd_sk")
    exports.export_gold({"dim_imd": frame(3)}, root, "2024-01-01")
    exports.export_gold({"dim_imd": frame(5)}, root, date(2024, 1, 2))
    exports.export_gold({"dim_imd": frame(6)}, root, date(2024, 1, 2))
    assert exports.list_exports(spark, root) == ["2024-01-02", "2024-01-01"]
    assert exports.read_export(spark, root, "dim_imd").count() == 6
    assert exports.read_export(spark, root, "dim_imd", "2024-01-01").count() == 3
    assert exports.read_export(spark, root, "dim_imd", every=True).count() == 9
    assert exports.read_export(spark, root, "dim_imd").columns == ["imd_sk"]
    with pytest.raises(ValueError):
        exports.read_export(spark, root, "dim_imd", "2023-01-01")
    with pytest.raises(ValueError):
        exports.export_gold({"dim_imd": frame(1)}, root, "first of May")
    with pytest.raises(ValueError):
        exports.table_path(root, "dim_secret")
    assert len(GOLD_TABLES) == 10


def test_result_sink_keeps_the_last_run_of_a_day(spark, tmp_path):
    shape = "table_name string, run_date date, run_status string, failure_count int, run_id string, details string"
    for run_id, day in (("x", 1), ("y", 1), ("z", 2)):
        rows = [("patients", date(2024, 1, day), "PASSED", 0, run_id, "{}")]
        exports.write_runs(spark.createDataFrame(rows, shape), str(tmp_path))
    assert {r.run_id for r in exports.read_runs(spark, str(tmp_path)).collect()} == {"y", "z"}
    assert {p.name for p in (tmp_path / "runs").iterdir() if p.is_dir()} == {"run_id=x", "run_id=y", "run_id=z"}


def test_merged_scan(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t/p=1"))
    spark.range(2).withColumn("extra", F.lit("x")).write.parquet(str(tmp_path / "t/p=2"))
    df = lake.read_merged(spark, str(tmp_path / "t"))
    assert df.count() == 4 and df.where("extra IS NULL").count() == 2


def test_files_that_disagree_on_types_are_read_as_one(spark):
    frames = {
        "a": spark.createDataFrame([(1, 1.5, date(2024, 1, 2))], "n short, x float, d date"),
        "b": spark.createDataFrame([(1 << 40, 3, "text")], "n long, x int, d string"),
        "c": spark.createDataFrame([(True,)], "flag boolean"),
    }
    rows, report = lake.reconcile(frames)
    assert dict(rows.dtypes) == {"n": "bigint", "x": "double", "d": "string", "flag": "boolean"}
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1, 1.5, "2024-01-02", None), (1 << 40, 3.0, "text", None), (None, None, None, True)], key=str
    )
    told = {(r.column, r.source): (r.given, r.taken, r.widened_to_text) for r in report.collect()}
    assert told["n", "a"] == ("short", "long", False) and told["d", "a"] == ("date", "string", True)
    assert told["flag", "a"] == (None, "boolean", False) and len(told) == 12
    with pytest.raises(ValueError, match="nested"):
        lake.reconcile({"a": spark.createDataFrame([([1],)], "v array<int>"), "b": spark.createDataFrame([(1,)], "v int")})


@pytest.mark.parametrize(
    "one, two, both",
    [("integer", "long", "long"), ("long", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "integer", "string"), ("decimal(10,2)", "decimal(12,2)", "string")],
)
def test_joined_types(one, two, both):
    assert lake.joined_type(one, two) == lake.joined_type(two, one) == both
