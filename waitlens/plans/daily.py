"""The daily run: land Bronze, conform, validate, build and export the star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from datetime import UTC, date, datetime
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.contracts import ENTITIES, SEX_CODES, declared_types
from waitlens.operators.conform import new_partitions, require_unique
from waitlens.operators.quality import (
    Check,
    QualityGateError,
    distinct_in_set,
    freshness,
    not_null,
    require_gate,
    row_count,
    run_suites,
    watched,
)
from waitlens.operators.readiness import readiness_report, readiness_verdict
from waitlens.plans.gold import build_gold
from waitlens.plans.silver import MODELS, Context
from waitlens.plans.suites import GOLD_SUITES, SILVER_SUITES
from waitlens.session import hide_key_material, settle, settled_folder
from waitlens.sources.drops import inventory, land_exports
from waitlens.sources.exports import export_gold, read_runs, write_runs
from waitlens.sources.keyed import KeyedTable
from waitlens.sources.lake import (
    coerce,
    landed_dates,
    listed_partitions,
    read_bronze,
    slice_by_date,
    snapshot,
    write_bronze,
    write_partitions,
)
from waitlens.sources.manifests import (
    RESULT_DDL,
    already_done,
    build_manifests,
    next_business_date,
    read_manifests,
    write_manifests,
)
from waitlens.sources.seeds import area_deprivation

# Checks that must hold before the star schema is rebuilt. About one record in seven
# has no surrogate because its patient is quarantined.
GATE_SUITES: dict[str, list[Check]] = {
    "patients": [row_count(1), not_null("patient_sk"), distinct_in_set("sex", SEX_CODES)],
    "encounters": [row_count(1), not_null("encounter_id"), not_null("patient_sk", mostly=0.80)],
    "referrals": [row_count(1), not_null("referral_id"), not_null("patient_sk", mostly=0.80)],
    "diagnoses": [row_count(0), not_null("diagnosis_id")],
}


#: Models conformed side by side.
MODELS_AT_ONCE = 4


@dataclass(frozen=True)
class Paths:
    """Folders of one environment, all on storage every executor reaches."""

    lake: str
    env: str = "dev"

    @property
    def manifests(self) -> str:
        return f"{self.lake}/_manifests"

    @property
    def quality(self) -> str:
        return f"{self.lake}/_dq"

    @property
    def files(self) -> str:
        return f"{self.lake}/_files"

    @property
    def freshness(self) -> str:
        return f"{self.lake}/_freshness"

    @property
    def readiness(self) -> str:
        return f"{self.lake}/_readiness"

    @property
    def exports(self) -> str:
        return f"{self.lake}/gold_export"

    def silver(self, model: str) -> str:
        return f"{self.lake}/{MODELS[model].database}/{model}"


def ingest_source(
    spark: SparkSession,
    paths: Paths,
    source: str,
    tables: Mapping[str, Callable[[], DataFrame | None]],
    run_date: date,
    mode: str = "business_date",
    fail_fast: bool = True,
) -> str:
    """Land the tables of one source under the run date and record a manifest.

    ``business_date`` keeps only rows of that date (entities without a business date land
    whole); ``snapshot`` lands the full tables. A date whose newest manifest is a success
    is skipped. A loader that returns None had nothing to land. Returns success, failed or
    skipped.
    """
    if mode not in ("business_date", "snapshot"):
        raise ValueError(f"unknown mode: {mode!r}")
    if already_done(read_manifests(spark, paths.manifests), source, run_date):
        return "skipped"
    run_id, started = str(uuid.uuid4()), _now()
    items = []
    for name, load in tables.items():
        entity = ENTITIES[name]
        try:
            rows = load()
            if rows is None:
                items.append((source, run_date, run_id, name, "skipped", None))
                continue
            if mode == "business_date" and entity.business_date:
                rows = slice_by_date(rows, entity.business_date, run_date)
            write_bronze(snapshot(rows, run_date), paths.lake, entity)
            items.append((source, run_date, run_id, name, "success", None))
        except (PySparkException, OSError) as problem:
            items.append((source, run_date, run_id, name, "failed", str(problem)))
            if fail_fast:
                break
    return record(spark, paths, items, started, inputs=list(tables))


def file_drop(
    spark: SparkSession, paths: Paths, name: str, root: str, run_date: date, multi_line: bool = False
) -> Callable[[], DataFrame | None]:
    """A loader for ``ingest_source``: the CSV files under ``root/export_date=YYYYMMDD``.

    Columns take the entity's declared types; what does not parse is NULL. Name, size and
    digest of each file are stored under ``paths.files`` by run date before the rows land.
    No files: nothing to land.
    """

    def load() -> DataFrame | None:
        rows = land_exports(spark, root, run_date, multi_line)
        if rows is None:
            return None
        found = inventory(spark, f"{root.rstrip('/')}/export_date={run_date:%Y%m%d}/*")
        write_partitions(found.withColumn("ingest_date", F.lit(run_date)), f"{paths.files}/{name}")
        kinds = {c: k for c, k in declared_types(ENTITIES[name]).items() if c in rows.columns}
        return coerce(rows.drop("ingest_date"), kinds)

    return load


def record(
    spark: SparkSession, paths: Paths, items: Sequence[tuple], started: datetime, inputs: Sequence[str] = ()
) -> str:
    """Write the manifests of item results (source, date, run, item, status, error).

    Returns the status over all of them.
    """
    outputs = [f"{i[3]}/ingest_date={i[1]}" for i in items if i[4] == "success"]
    idle = "nothing to land" if all(i[4] == "skipped" for i in items) else None
    told = (paths.env, started, _now(), idle, list(inputs), outputs)
    results = spark.createDataFrame([(*i, *told) for i in items], RESULT_DDL)
    write_manifests(build_manifests(results), paths.manifests)
    statuses = {i[4] for i in items}
    return "failed" if "failed" in statuses else "success" if "success" in statuses else "skipped"


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def conform(
    spark: SparkSession, paths: Paths, ctx: Context, lookback_days: int = 0
) -> dict[str, DataFrame]:
    """Upsert every conformed table with the Bronze partitions it has not loaded.

    Each table records the partitions it holds, so one that lands late is loaded when it
    comes, and nothing is scanned to find out. A late partition does not replace what newer
    ones delivered. The vault is conformed first; the other models do not depend on each
    other and run side by side.
    """
    areas = area_deprivation(spark)
    vault = KeyedTable(spark, paths.silver("patient_identifiers"))

    def one(name: str) -> None:
        model = MODELS[name]
        entity = ENTITIES[model.source]
        table = KeyedTable(spark, paths.silver(name), model.sort_by, model.bucket)
        loaded = [date.fromisoformat(d) for d in table.loaded()]
        days = new_partitions(landed_dates(spark, paths.lake, entity), loaded, lookback_days)
        if not days and table.exists():
            return
        fresh = read_bronze(spark, paths.lake, entity, days)
        extra = {"areas": areas, "vault": vault.read(), "": None}[model.needs]
        batch = model.build(fresh, ctx) if extra is None else model.build(fresh, extra, ctx)
        # The batch is checked for its keys and then merged: compute it once.
        batch = settle(batch)
        require_unique(batch, [model.merge_key])
        table.merge(batch, [model.merge_key], ["_ingest_date"], ["_loaded_at"])
        table.record(d.isoformat() for d in days)

    one("patient_identifiers")
    with ThreadPoolExecutor(MODELS_AT_ONCE) as pool:
        tasks = [pool.submit(copy_context().run, one, n) for n in MODELS if n != "patient_identifiers"]
        for task in tasks:
            task.result()
    return {m: KeyedTable(spark, paths.silver(m)).read() for m in MODELS}


def check_freshness(spark: SparkSession, paths: Paths, entities: Sequence[str], run_date: date) -> DataFrame:
    """Age of each entity's newest partition, stored; raises when one is too old.

    Read off folder names; (entity, latest, age_days, status).
    """
    landed = listed_partitions(spark, paths.lake, [ENTITIES[e] for e in entities]).where(F.col("ingest_date") <= F.lit(run_date))
    parts = [
        freshness(landed.where(F.col("entity") == e), run_date).select(F.lit(e).alias("entity"), "*") for e in entities
    ]
    ages = settle(reduce(DataFrame.unionByName, parts))
    write_partitions(ages.withColumn("run_date", F.lit(run_date)), paths.freshness, "run_date")
    late = [r.entity for r in ages.where("status = 'error'").collect()]
    if late:
        raise QualityGateError(f"no recent partition of {', '.join(late)}")
    return ages


def assess(spark: SparkSession, paths: Paths, entities: Sequence[str], run_date: date) -> bool:
    """Whether landed Bronze is ready to be conformed; the findings are stored."""
    frames = {e: read_bronze(spark, paths.lake, ENTITIES[e]) for e in entities}
    report = settle(readiness_report(spark, frames))
    write_partitions(report.withColumn("run_date", F.lit(run_date)), paths.readiness, "run_date")
    return readiness_verdict(report).first().ready


def validate(
    spark: SparkSession,
    paths: Paths,
    silver: Mapping[str, DataFrame],
    run_date: date,
    suites: Mapping[str, list[Check]] = GATE_SUITES,
    silver_suites: Mapping[str, list[Check]] = SILVER_SUITES,
) -> None:
    """Run the gate suites and the declared Silver tests, store the results, raise when
    promotion is blocked."""
    for checks, path in ((suites, paths.quality), (silver_suites, f"{paths.quality}_silver")):
        if checks:
            write_runs(run_suites(spark, silver, checks, str(uuid.uuid4()), run_date), path)
    for checks, path in ((suites, paths.quality), (silver_suites, f"{paths.quality}_silver")):
        if checks:
            require_gate(read_runs(spark, path), run_date)


def publish(
    spark: SparkSession,
    paths: Paths,
    silver: Mapping[str, DataFrame],
    run_date: date,
    suites: Mapping[str, list[Check]] = GOLD_SUITES,
) -> dict[str, DataFrame]:
    """Build the star schema, test it, and export it under the run date.

    The tables are settled first: the tests and the export read the same rows, computed
    once. Tests that are plain counts are taken while a table is settled and read nothing
    again. Nothing is exported when a test fails.
    """
    gold, found = {}, {}
    for name, df in build_gold(spark, silver).items():
        passing, seen = watched(df, name, suites.get(name, []))
        gold[name] = settle(passing)
        told = seen()
        if told is not None:
            found[name] = told
    runs = run_suites(spark, gold, suites, str(uuid.uuid4()), run_date, found)
    write_runs(runs, f"{paths.quality}_gold")
    if suites:
        require_gate(read_runs(spark, f"{paths.quality}_gold"), run_date)
    export_gold(gold, paths.exports, run_date)
    return gold


def run_day(
    spark: SparkSession,
    paths: Paths,
    sources: Mapping[str, Mapping[str, Callable[[], DataFrame]]],
    ctx: Context,
    run_date: date | None = None,
    mode: str = "business_date",
    suites: Mapping[str, list[Check]] = GATE_SUITES,
    lookback_days: int = 0,
    gold_suites: Mapping[str, list[Check]] = GOLD_SUITES,
    silver_suites: Mapping[str, list[Check]] = SILVER_SUITES,
    readiness: str = "off",
) -> date:
    """One complete run. Without a date it takes the one after the last complete day.

    ``readiness`` is ``off``, ``report`` (findings are stored) or ``block`` (and Bronze that
    is not ready is not conformed). Intermediate tables of the run are deleted when it ends.
    """
    if readiness not in ("off", "report", "block"):
        raise ValueError(f"unknown readiness: {readiness!r}")
    with settled_folder(spark):
        return _run_day(
            spark, paths, sources, ctx, run_date, mode, suites, lookback_days, gold_suites, silver_suites, readiness
        )


def _run_day(
    spark, paths, sources, ctx, run_date, mode, suites, lookback_days, gold_suites, silver_suites, readiness
) -> date:
    hide_key_material(spark)
    if run_date is None:
        row = next_business_date(
            read_manifests(spark, paths.manifests).where(F.col("source").isin(list(sources)))
        ).first()
        if row.next_date is None:
            raise ValueError("no earlier run to continue from: name the run date")
        run_date = row.next_date
    failed = [
        s for s, tables in sources.items()
        if ingest_source(spark, paths, s, tables, run_date, mode) == "failed"
    ]
    if failed:
        raise RuntimeError(f"ingestion failed for {', '.join(failed)}; see the manifests")
    delivered = [name for tables in sources.values() for name in tables]
    check_freshness(spark, paths, delivered, run_date)
    if readiness != "off" and not assess(spark, paths, delivered, run_date) and readiness == "block":
        raise QualityGateError(f"Bronze is not ready on {run_date}; see {paths.readiness}")
    silver = conform(spark, paths, ctx, lookback_days)
    validate(spark, paths, silver, run_date, suites, silver_suites)
    publish(spark, paths, silver, run_date, gold_suites)
    return run_date
