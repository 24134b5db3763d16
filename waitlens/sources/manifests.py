"""Run manifests: what was ingested, what may be skipped, which date comes next."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.sources.files import exists

#: What a run of a source is told about besides its items; absent ones are NULL.
RUN_FIELDS = {
    "env": "string",
    "started_at": "timestamp_ntz",
    "finished_at": "timestamp_ntz",
    "reason": "string",
    "inputs": "array<string>",
    "outputs": "array<string>",
}
ITEM_RESULTS = "source string, ingest_date date, run_id string, item string, status string, error string"
RESULT_DDL = ", ".join([ITEM_RESULTS, *(f"{n} {t}" for n, t in RUN_FIELDS.items())])


def build_manifests(results: DataFrame) -> DataFrame:
    """One manifest per run from its item results.

    ``results`` has (source, ingest_date, run_id, item, status, error) and may have the
    ``RUN_FIELDS``. A run failed when an item did, and was skipped when all items were.
    Items of a run are the tables or files of one source on one date.
    """
    failed = F.col("status") == "failed"
    skipped = F.count_if(F.col("status") == "skipped") == F.count("*")
    given = {n: F.col(n) if n in results.columns else F.lit(None) for n in RUN_FIELDS}
    told = {
        "env": F.max(given["env"].cast("string")),
        "started_at": F.min(given["started_at"].cast("timestamp_ntz")),
        "finished_at": F.max(given["finished_at"].cast("timestamp_ntz")),
        "reason": F.max(given["reason"].cast("string")),
        "inputs": F.array_sort(F.array_distinct(F.flatten(F.collect_list(given["inputs"].cast("array<string>"))))),
        "outputs": F.array_sort(F.array_distinct(F.flatten(F.collect_list(given["outputs"].cast("array<string>"))))),
    }
    return results.groupBy("source", "ingest_date", "run_id").agg(
        F.when(F.count_if(failed) > 0, "failed").when(skipped, "skipped").otherwise("success").alias("status"),
        *[c.alias(n) for n, c in told.items()],
        F.sort_array(F.collect_list(F.when(failed, F.col("error")))).alias("error"),
        F.sort_array(F.collect_list(F.struct("item", "status", "error"))).alias("items"),
        F.count_if(F.col("status") == "success").alias("items_succeeded"),
        F.count_if(failed).alias("items_failed"),
    )


def write_manifests(manifests: DataFrame, root: str) -> None:
    """Append manifests as JSON under ``source=/ingest_date=``."""
    manifests.write.mode("append").partitionBy("source", "ingest_date").json(root)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """All manifests with the time each was written. Text that is not JSON has no status."""
    shape = "run_id string, status string, error array<string>, reason string"
    if not exists(spark, root):
        return spark.createDataFrame(
            [], f"{shape}, source string, ingest_date date, modified_at timestamp_ntz"
        )
    raw = spark.read.schema(f"{shape}, _bad string, source string, ingest_date date").option(
        "columnNameOfCorruptRecord", "_bad"
    ).json(root)
    return raw.select(
        "run_id",
        "status",
        "error",
        "reason",
        "source",
        "ingest_date",
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified_at"),
    )


def newest_status(manifests: DataFrame, tiebreak: Sequence[str] = ("run_id",)) -> DataFrame:
    """Status of the newest manifest per source and date."""
    order = F.struct("modified_at", *tiebreak)
    return manifests.groupBy("source", "ingest_date").agg(
        F.max_by(F.coalesce("status", F.lit("unreadable")), order).alias("status")
    )


def should_skip(manifests: DataFrame, tiebreak: Sequence[str] = ("run_id",)) -> DataFrame:
    """Per source and date: whether the newest manifest is a success."""
    return newest_status(manifests, tiebreak).select(
        "source", "ingest_date", (F.col("status") == "success").alias("skip")
    )


def already_done(manifests: DataFrame, source: str, run_date: date) -> bool:
    match = manifests.where((F.col("source") == source) & (F.col("ingest_date") == F.lit(run_date)))
    row = should_skip(match).first()
    return bool(row and row.skip)


def latest_success(manifests: DataFrame, tiebreak: Sequence[str] = ("run_id",)) -> DataFrame:
    """Latest date per source whose newest manifest is a success."""
    done = newest_status(manifests, tiebreak).where(F.col("status") == "success")
    return done.groupBy("source").agg(F.max("ingest_date").alias("latest"))


def next_business_date(manifests: DataFrame, tiebreak: Sequence[str] = ("run_id",)) -> DataFrame:
    """One row: the day after the earliest of the sources' latest dates, or NULL."""
    return latest_success(manifests, tiebreak).agg(
        F.date_add(F.min("latest"), 1).alias("next_date")
    )
