"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local threads. Each query runs once
cold and once more; the second time is reported. ``whole_day`` is one complete daily run; the
wait and urgent-care reports then read its export (``g1_export`` and so on), or the cells made
from it (``g1_cells``). Every result is written out in full to
a sink that discards it, so nothing is optimised away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from dataclasses import replace
from datetime import date
from pathlib import Path

from tests.session import local_session
from waitlens.contracts import ENTITIES
from waitlens.operators.quality import row_count
from waitlens.plans import daily, reports, silver
from waitlens.plans.suites import GOLD_SUITES
from waitlens.session import scratch_path
from waitlens.sources.exports import read_export
from workload.queries import REGISTRY
from workload.roles import TEST_KEY, Roles

HEADLINE = (
    "a6_backfill_partitions",
    "b2_dedup_latest",
    "b3_upsert",
    "b5_mod11",
    "b7_hmac",
    "b20_patients",
    "b23_encounters",
    "b26_diagnostics_orders",
    "b27_appointments",
    "d1_first_match",
    "d4_fct_wait_times",
    "d6_fct_urgent_care",
    "d8_fct_utilisation",
    "d9_stratified_metrics",
    "d14_fct_inequality",
    "d14_quantity_inequality",
    "e9_suite_runs",
    "f4_references",
    "f7_column_profile",
    "b9_resolve_bucketed",
    "c3_as_of",
    "g10_busiest_hours",
    "h1_incremental_upsert",
    "h1_newest_first",
    "h2_event_windows",
    "h4_staleness",
)


def whole_day(spark, sf_dir: str) -> daily.Paths:
    """Bronze to export for all eight entities: land, conform, validate, build, export."""
    paths = daily.Paths(scratch_path(spark, "bench-lake"))
    sources: dict[str, dict] = {}
    for name, df in Roles(spark, sf_dir).bronze.items():
        rows = df.drop("ingest_date")
        sources.setdefault(ENTITIES[name].source, {})[name] = lambda rows=rows: rows
    daily.run_day(
        spark,
        paths,
        sources,
        silver.Context(TEST_KEY),
        date(2024, 6, 1),
        mode="snapshot",
        # The test data has more unusable numbers than the standard gate lets pass.
        suites=daily.GATE_SUITES | {t: [row_count(1)] for t in ("encounters", "referrals")},
        # Some of its patients have no sex, so one stratum has no name.
        gold_suites=GOLD_SUITES | {"fct_inequality": [row_count(1)]},
    )
    return paths


def exported_reports(spark, paths: daily.Paths) -> dict:
    """Report name -> frame, on the tables of an export and on the cells of its waits."""
    read = lambda t: read_export(spark, paths.exports, t)
    cells = f"{paths.lake}/wait_cells"
    reports.wait_cells(read("fct_wait_times")).write.parquet(cells)
    gold = reports.Gold(
        waits=read("fct_wait_times"), urgent=read("fct_urgent_care"), patients=read("dim_patient"),
        sites=read("dim_site"), specialties=read("dim_specialty"),
    )
    stored = replace(gold, waits=spark.read.parquet(cells))
    return {
        "g1_export": lambda: reports.wait_kpis(gold),
        "g2_export": lambda: reports.wait_by_provider(gold),
        "g3_export": lambda: reports.wait_trend(gold),
        "g7_export": lambda: reports.urgent_kpis(gold),
        "g1_cells": lambda: reports.wait_kpis(stored),
        "g2_cells": lambda: reports.wait_by_provider(stored),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    cold, warm = {}, {}
    for name in chosen:
        for times in (cold, warm):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: cold {cold[name]}, warm {warm[name]}", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        start = time.perf_counter()
        paths = whole_day(spark, sf_dir)
        warm["whole_day"] = round(time.perf_counter() - start, 3)
        print(f"whole_day: {warm['whole_day']}", file=sys.stderr, flush=True)
        for name, report in exported_reports(spark, paths).items():
            for times in (cold, warm):
                start = time.perf_counter()
                report().write.format("noop").mode("overwrite").save()
                times[name] = round(time.perf_counter() - start, 3)
            print(f"{name}: cold {cold[name]}, warm {warm[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, second run",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
