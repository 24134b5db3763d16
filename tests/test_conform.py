from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from waitlens.contracts import ENTITIES
from waitlens.operators import conform
from waitlens.operators.dims import calendar, dense_key
from waitlens.operators.measures import milestones
from waitlens.plans import silver
from waitlens.sources import keyed
from waitlens.sources.keyed import KeyedTable, digits_bucket, hash_bucket, range_bucket


def test_increment_marks(spark):
    rows = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 6)], "ingest_date date, x int")
    days = lambda df: sorted(r.x for r in df.collect())
    assert conform.high_water_mark(None) is None
    empty = rows.where("x > 99").withColumnRenamed("ingest_date", "_ingest_date")
    assert conform.high_water_mark(empty) is None
    assert days(conform.increment(rows, None)) == [1, 2, 3, 4, 5]
    assert days(conform.increment(rows, date(2024, 1, 3))) == [4, 5]
    assert days(conform.increment(rows, date(2024, 1, 3), lookback_days=1)) == [3, 4, 5]


def test_increment_prunes_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 6)], "ingest_date date, x int")
    rows.write.partitionBy("ingest_date").parquet(str(tmp_path / "t"))
    fresh = conform.increment(spark.read.parquet(str(tmp_path / "t")), date(2024, 1, 3))
    assert len(fresh.inputFiles()) >= 2
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_dedup_nulls_rank_highest_and_ties_are_settled(spark):
    rows = [(1, None, "a"), (1, 5, "z"), (2, 3, "a"), (2, 3, "b"), (3, 1, None), (3, 1, "q")]
    df = spark.createDataFrame(rows, "k int, o int, t string")
    once = conform.dedup_latest(df, ["k"], ["o"], ["t"])
    assert sorted((r.k, r.o, r.t) for r in once.collect()) == [(1, None, "a"), (2, 3, "b"), (3, 1, None)]
    again = conform.dedup_latest(once, ["k"], ["o"], ["t"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    with pytest.raises(ValueError):
        conform.dedup_latest(df, ["k"], ["o"], [])


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o")).write.parquet(
        str(tmp_path / "t")
    )
    df = conform.dedup_latest(spark.read.parquet(str(tmp_path / "t")), ["k"], ["o"], ["o"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_dedup_against_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.4 else rng.randrange(50), rng.randrange(20), i) for i in range(5000)]
    best = defaultdict(lambda: (-1, -1))
    for k, o, i in rows:
        best[k] = max(best[k], (o, i))
    df = spark.createDataFrame(rows, "k int, o int, i int")
    got = {r.k: (r.o, r.i) for r in conform.dedup_latest(df, ["k"], ["o"], ["i"]).collect()}
    assert got == dict(best)


def test_left_join_scatters_missing_keys(spark):
    rows = [(i, None if i % 3 == 0 else i % 7) for i in range(300)]
    left = spark.createDataFrame(rows, "id int, k int")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k2 int, v string")
    joined = conform.left_join_on(left, right.hint("merge"), F.col("k"), "k2", ["id"])
    got = {r.id: r.v for r in joined.collect()}
    assert got == {i: (f"v{k}" if k is not None and k < 5 else None) for i, k in rows}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert keys and all("_key" in line and "_scatter" in line for line in keys)


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def files_of(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.glob("_bucket=*/*.parquet")}


def test_merge_is_idempotent_and_keeps_the_rest(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    assert table.read() is None
    table.merge(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    for _ in range(2):
        assert table.merge(batch, ["k"])
        assert rows_of(table) == [(1, "a"), (2, "B"), (3, "C")]


def test_merge_follows_the_batch_schema(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), (), range_bucket("k", 1))
    table.merge(spark.createDataFrame([(1, "a", 9), (2, "x", 8)], "k int, v string, gone int"), ["k"])
    table.merge(spark.createDataFrame([(2, "b", 1.5)], "k int, v string, fresh double"), ["k"])
    rows = {r.k: r.asDict() for r in table.read().collect()}
    assert rows == {1: {"k": 1, "v": "a", "fresh": None}, 2: {"k": 2, "v": "b", "fresh": 1.5}}
    table.merge(spark.createDataFrame([("3", "three")], "k string, v string"), ["k"])
    assert rows_of(table) == [("1", "a"), ("2", "b"), ("3", "three")]


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = tmp_path / "t"
    table = KeyedTable(spark, str(path), ["k"], range_bucket("k", 10))
    table.merge(spark.createDataFrame([(i, "old") for i in range(40)], "k int, v string"), ["k"])
    before = files_of(path)
    batch = [(15, "new"), (17, "new"), (41, "new")]
    table.merge(spark.createDataFrame(batch, "k int, v string"), ["k"])
    after = files_of(path)
    changed = {f.split("/")[0] for f in after if after[f] != before.get(f)} | {f.split("/")[0] for f in before if f not in after}
    assert changed == {"_bucket=1", "_bucket=4"}
    assert dict(rows_of(table)) == {i: "old" for i in range(40)} | dict(batch)
    assert not list(path.glob("_staged/*"))


def test_buckets_take_missing_and_text_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), (), hash_bucket("k", 3))
    batch = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, v int")
    table.merge(batch, ["k"])
    table.merge(spark.createDataFrame([("k3", 33)], "k string, v int"), ["k"])
    rows = {r.k: r.v for r in table.read().collect()}
    assert rows == {f"k{i}": i for i in range(20)} | {"k3": 33}
    table.merge(spark.createDataFrame([], "k string, v int"), ["k"])
    assert table.read().count() == 20
    with pytest.raises(conform.MissingKeyError):
        table.merge(spark.createDataFrame([(None, 1)], "k string, v int"), ["k"])


def test_an_empty_table_has_its_schema(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), (), range_bucket("k"))
    table.merge(spark.createDataFrame([], "k int, v string"), ["k"])
    assert rows_of(table) == [] and table.read().columns == ["k", "v"]
    table.merge(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    assert rows_of(table) == [(1, "a")]


def test_the_stored_bucket_rule_stands(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, "old") for i in range(40)], "k int, v string")
    KeyedTable(spark, path, (), range_bucket("k", 10)).merge(rows, ["k"])
    other = KeyedTable(spark, path, (), range_bucket("k", 3))
    other.merge(spark.createDataFrame([(7, "new")], "k int, v string"), ["k"])
    assert other.rule().size == 10
    assert sorted(r.v for r in other.read().where("k = 7").collect()) == ["new"] and other.read().count() == 40
    with pytest.raises(ValueError, match="bucketed by"):
        KeyedTable(spark, path, (), hash_bucket("k", 3)).merge(rows, ["k"])


def test_bucket_sizes_follow_the_first_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 10)
    rows = spark.createDataFrame([(f"A{i * 1000}", i) for i in range(40)], "k string, v int")
    table = KeyedTable(spark, str(tmp_path / "t"), (), digits_bucket("k"))
    table.merge(rows, ["k"])
    assert table.rule().size == 9751
    table.merge(spark.createDataFrame([("A1000", -1), ("none", -2)], "k string, v int"), ["k"])
    assert table.read().where("v < 0").count() == 2 and table.read().count() == 41


def test_newest_row_stays_in_whatever_order_batches_come(spark, tmp_path):
    rows = [(k, at, f"{k}/{at}") for k in range(6) for at in range(k + 1)] + [(1, None, "unknown counts as newest")]
    want = sorted([(k, f"{k}/{k}") for k in range(6) if k != 1] + [(1, "unknown counts as newest")])
    for n, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 2, 0])):
        table = KeyedTable(spark, str(tmp_path / f"t{n}"), (), range_bucket("k", 2))
        for part in order:
            batch = [r for i, r in enumerate(rows) if i % 3 == part]
            table.merge(spark.createDataFrame(batch, "k int, at int, v string"), ["k"], ["at"])
        assert [(k, v) for k, _, v in rows_of(table)] == want
    # Of rows that tie, the one that comes last.
    table.merge(spark.createDataFrame([(5, 5, "again")], "k int, at int, v string"), ["k"], ["at"])
    assert dict((k, v) for k, _, v in rows_of(table))[5] == "again"


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    frame = lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    assert table.merge(frame("a"), ["k"], batch_id="b1") and table.merge(frame("b"), ["k"], batch_id="b2")
    assert not table.merge(frame("a"), ["k"], batch_id="b1")
    assert rows_of(table) == [(1, "b")] and table.loaded() == ["b1", "b2"]


def test_an_overwrite_cut_short_is_repeated(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), (), range_bucket("k", 10))
    table.merge(spark.createDataFrame([(i, "old") for i in range(30)], "k int, v string"), ["k"])
    batch = spark.createDataFrame([(5, "new"), (25, "new")], "k int, v string")

    def dies(self, aside):
        # As if the driver died when one partition was gone and none was back.
        import shutil

        shutil.rmtree(tmp_path / "t" / "_bucket=0")
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_put", dies)
        with pytest.raises(RuntimeError):
            table.merge(batch, ["k"], batch_id="b1")
    assert table.read().count() == 20
    # The replay finds the rows aside and is then recorded.
    assert not table.merge(batch, ["k"], batch_id="b1")
    assert dict(rows_of(table)) == {i: "new" if i in (5, 25) else "old" for i in range(30)}
    # What was not written to its end is no part of the table.
    (tmp_path / "t" / "_staged" / "b2" / "_bucket=0").mkdir(parents=True)
    table.merge(batch, ["k"], batch_id="b2")
    assert table.read().count() == 30


def test_partitions_that_land_late_are_new():
    day = lambda n: date(2024, 1, n)
    assert conform.new_partitions([day(1), day(3), day(2)], [day(1), day(3)]) == [day(2)]
    assert conform.new_partitions([day(1), day(2), day(3)], [day(1), day(2), day(3)], lookback_days=1) == [day(3)]
    assert conform.new_partitions([day(2), day(1)], []) == [day(1), day(2)]


def test_merge_refuses_a_repeated_key(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    with pytest.raises(conform.DuplicateKeyError):
        table.merge(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"])
    assert table.read() is None


def patients(spark, rows):
    """Rows of (patient_id, number, updated_at day)."""
    base = {f.name: None for f in ENTITIES["patient_demographics"].schema()}
    full = [
        {**base, "patient_id": p, "nhs_pseudo_id": n, "updated_at": datetime(2024, 1, d),
         "ingest_date": date(2024, 1, d)}
        for p, n, d in rows
    ]
    return spark.createDataFrame(full, ENTITIES["patient_demographics"].schema())


CTX = silver.Context(b"k", missing_reason=None)


def test_filter_order_differs_between_valid_and_quarantine(spark):
    rows = patients(
        spark,
        [(1, "9434765919", 1), (1, "9434765910", 2), (2, "9434765910", 1), (2, "1234567881", 2), (3, "12", 1)],
    )
    vault = {r.patient_id for r in silver.patient_identifiers(rows, CTX).collect()}
    bad = {r.patient_id: r.rejection_reason for r in silver.patients_quarantine(rows, CTX).collect()}
    assert vault == {1, 2}
    assert bad == {1: "mod11_mismatch", 3: "invalid_format"}


def test_missing_number_is_valid_unless_named(spark):
    rows = patients(spark, [(1, None, 1)])
    assert [r.patient_sk for r in silver.patient_identifiers(rows, CTX).collect()] == [None]
    strict = silver.Context(b"k")
    assert silver.patient_identifiers(rows, strict).count() == 0
    assert [r.rejection_reason for r in silver.patients_quarantine(rows, strict).collect()] == ["missing"]


def test_two_ids_sharing_a_number_collide_on_the_surrogate(spark, tmp_path):
    rows = patients(spark, [(1, "9434765919", 1), (2, "9434765919", 1)])
    batch = silver.patient_identifiers(rows, CTX)
    with pytest.raises(conform.DuplicateKeyError):
        KeyedTable(spark, str(tmp_path / "t")).merge(batch, ["patient_sk"])


def orders(spark, ids):
    base = {f.name: None for f in ENTITIES["diagnostics_orders"].schema()}
    rows = [
        {**base, "diagnostic_id": i, "request_date": "2024-01-01", "ingest_date": date(2024, 1, 1)} for i in ids
    ]
    return spark.createDataFrame(rows, ENTITIES["diagnostics_orders"].schema())


def test_diagnostic_ids_that_differ_only_in_letters(spark):
    vault = silver.patient_identifiers(patients(spark, []), CTX)
    both = silver.diagnostics_orders(orders(spark, ["D1", "X1"]), vault, CTX)
    assert [r.diagnostic_id for r in both.collect()] == [1, 1]
    one = silver.diagnostics_orders(orders(spark, ["D1", "X1"]), vault, CTX, dedup_conformed=True)
    assert [r.diagnostic_id for r in one.collect()] == [1]


def test_empty_sources_give_empty_tables(spark):
    vault = silver.patient_identifiers(patients(spark, []), CTX)
    empty = spark.createDataFrame([], ENTITIES["diagnoses"].schema())
    out = silver.diagnoses(empty, vault, CTX)
    assert out.count() == 0 and "patient_sk" in out.columns


def test_context_does_not_print_its_key():
    assert "secret" not in repr(silver.Context(b"secret"))


def test_personal_columns_stop_at_silver(spark):
    vault = silver.patient_identifiers(patients(spark, []), CTX)
    sites = silver.providers(spark.createDataFrame([], ENTITIES["provider_site_reference"].schema()), CTX)
    assert not {"site_manager_name", "site_manager_email"} & set(sites.columns)
    booked = silver.appointments(spark.createDataFrame([], ENTITIES["appointments"].schema()), vault, CTX)
    assert not {"nhs_pseudo_id", "imd_decile", "patient_id"} & set(booked.columns)


def test_dense_key_numbers_in_order_over_many_partitions(spark):
    names = [f"n{i * 7919 % 5000:05d}" for i in range(5000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    rows = dense_key(df, ["name"], "sk").collect()
    assert [n for _, n in sorted((r.sk, r.name) for r in rows)] == sorted(names)
    assert sorted(r.sk for r in rows) == list(range(1, 5001))


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 4018
    row = days.where("date_sk = 20240107").first()
    assert (row.year, row.quarter, row.month_label, row.day_of_week, row.is_weekend) == (
        2024, 1, "Jan 2024", 0, True,
    )


def test_a_hot_key_is_split_by_the_adaptive_skew_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        row = F.col("id")
        facts = spark.range(0, 300_000, 1, 8).select(
            row, F.when(row % 3 == 0, 7).otherwise(row % 5000).alias("patient_id"), F.sha2(row.cast("string"), 256).alias("x")
        )
        vault = spark.range(5000).select(row.alias("patient_id"), F.concat(F.lit("sk"), row).alias("patient_sk"))
        joined = conform.resolve_key(facts, vault, F.col("patient_id"), ["id"])
        got = joined.groupBy((F.col("patient_sk") == "sk7").alias("hot")).agg(
            F.count("id").alias("n"), F.max("x")
        )
        counts = {r.hot: r.n for r in got.collect()}
        assert counts[True] == 100_000 + sum(1 for i in range(300_000) if i % 3 and i % 5000 == 7)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_diagnostics_read_without_their_patient_need_no_vault(spark):
    vault = spark.createDataFrame([(1, "s")], "patient_id bigint, patient_sk string")
    found = silver.diagnostics_orders(orders(spark, ["D1", "X2"]), vault, CTX)
    tests = milestones(found, "referral_id", "request_date", {"asked": "request_date", "answered": "result_date"})
    assert "Join" not in tests._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in found.select("patient_sk")._jdf.queryExecution().optimizedPlan().toString()
