"""Bucketed references, intervals of versions, report cells."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from waitlens.operators.dims import as_of, versions
from waitlens.plans import reports
from waitlens.sources import bucketed
from waitlens.sources.keyed import range_bucket
from waitlens.sources.keyring import Keyring


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def vault(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"s{i}") for i in range(1000)], "id bigint, sk string")
    yield bucketed.write_bucketed(rows, "stored_vault", str(tmp_path / "v"), "id", 4)
    spark.sql("DROP TABLE stored_vault")


def test_the_stored_side_is_not_shuffled(spark, vault, no_broadcast):
    rows = [(i, i * 7 % 1300 if i % 5 else None) for i in range(2000)] + [(i, 77) for i in range(2000, 3000)]
    facts = spark.createDataFrame(rows, "fact int, id int")
    joined = bucketed.join_stored(facts, vault, F.col("id"), "id", ["sk"])
    got = Counter((r.fact, r.id, r.sk) for r in joined.collect())
    assert got == Counter((f, i, f"s{i}" if i is not None and i < 1000 else None) for f, i in rows)
    lines = plan(joined).splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line]
    assert scans, plan(joined)
    # Between a join and the stored scan below it there is no exchange.
    for at in scans:
        above = lines[max(0, at - 4) : at]
        assert not any("Exchange hashpartitioning" in line for line in above)
    assert bucketed.hot_keys(facts, F.col("id")) == [77]


def test_orphans_meet_their_parents_in_place(spark, vault, no_broadcast):
    child = spark.createDataFrame([(i % 1010,) for i in range(5000)] + [(None,)], "id int")
    counts = bucketed.orphans(child, "id", vault, "id")
    assert tuple(counts.first()) == (1010, 10)
    assert plan(counts).count("Exchange hashpartitioning") == 1


def test_a_stored_table_opens_in_another_session(spark, vault, tmp_path):
    again = bucketed.open_bucketed(spark, "stored_again", str(tmp_path / "v"), "id", 4)
    assert again.count() == 1000
    spark.sql("DROP TABLE stored_again")


def day(n):
    return date(2024, 1, n)


def test_versions_open_where_something_changes(spark):
    rows = [
        (1, day(1), "a", None, 0), (1, day(3), "a", None, 0), (1, day(5), "b", None, 0), (1, day(5), "c", None, 1),
        (1, day(7), "c", 2, 0), (1, day(9), "a", None, 0), (2, day(4), None, None, 0), (2, day(6), None, None, 0),
        (None, day(1), "x", 1, 0), (3, None, "x", 1, 0),
    ]
    df = spark.createDataFrame(rows, "k int, at date, v string, w int, n int")
    got = [tuple(r) for r in versions(df, "k", ["v", "w"], "at", ["n"]).where("k = 1").orderBy("valid_from").collect()]
    assert got == [
        (1, "a", None, day(1), day(5), False), (1, "c", None, day(5), day(7), False),
        (1, "c", 2, day(7), day(9), False), (1, "a", None, day(9), None, True),
    ]
    (only,) = versions(df, "k", ["v", "w"], "at", ["n"]).where("k = 2").collect()
    assert tuple(only) == (2, None, None, day(4), None, True)
    facts = spark.createDataFrame([(i, 1, day(i)) for i in range(1, 12)] + [(20, None, day(1)), (21, 1, None), (22, 9, day(1)), (23, 2, day(3))], "f int, k int, at date")
    found = {r.f: (r.v, r.w) for r in as_of(facts, versions(df, "k", ["v", "w"], "at", ["n"]), "k", "at", ["v", "w"]).collect()}
    want = {i: ("a", None) if i < 5 or i >= 9 else ("c", None if i < 7 else 2) for i in range(1, 12)}
    assert found == want | {i: (None, None) for i in (20, 21, 22, 23)}


def test_cells_answer_like_facts(spark):
    rows = [(i % 3, i % 4, day(1 + i % 2), None if i % 11 == 0 else i * i % 400, i % 5 == 0) for i in range(500)]
    facts = spark.createDataFrame(rows, "site_sk int, specialty_sk int, treatment_month date, wait_days int, rtt_breach_flag boolean")
    sites = spark.createDataFrame([(i, f"p{i}") for i in range(3)], "site_sk int, provider_name string")
    kinds = spark.createDataFrame([(i, f"s{i}") for i in range(4)], "specialty_sk int, specialty_name string")
    cells = reports.wait_cells(facts)
    assert cells.agg(F.sum(reports.CELL_COUNT)).first()[0] == 500
    models = [reports.Gold(waits=w, sites=sites, specialties=kinds) for w in (facts, cells)]
    for ask in (reports.wait_kpis, reports.wait_by_provider, reports.wait_trend):
        for args in ((), (["p1"],), (["p1", "p2"], ["s0", "s3"]), (["none"],)):
            one, two = (ask(m, *args).collect() for m in models)
            assert one == two


def test_a_repeated_key_is_found_across_batches(spark, tmp_path):
    ring = Keyring(spark, str(tmp_path / "ring"), "k", range_bucket("k", 10))
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "k int")
    found = lambda df: sorted(map(tuple, df.collect()))
    assert found(ring.add(frame([1, 2, 2, 15, None, None]), "d1")) == [(2, 2, None)]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "ring").glob("_bucket=0/*.parquet")}
    # Only the buckets of the batch are read and written.
    assert found(ring.add(frame([15, 16, 27]), "d2")) == [(15, 1, "d1")]
    scan = next(line for line in plan(ring.table.near(frame([15, 27]))).splitlines() if "FileScan" in line)
    assert "PartitionFilters: [_bucket" in scan
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "ring").glob("_bucket=0/*.parquet")}
    assert found(ring.add(frame([15, 16, 27]), "d2")) == [(15, 1, "d1")]
    assert found(ring.add(frame([1, 16, 40]), "d3")) == [(1, 1, "d1"), (16, 1, "d2")]
    assert sorted(r.k for r in ring.table.read().collect()) == [1, 2, 15, 16, 27, 40]
    assert found(ring.add(frame([]), "d4")) == []
