"""The historical load: whole extracts coerced, dated and landed, with a manifest per date."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.contracts import BACKFILL_TYPES, ENTITIES
from waitlens.plans.daily import Paths, _now
from waitlens.session import settle
from waitlens.sources.lake import backfill, backfill_by_file_name, bronze_path, coerce, write_bronze, write_partitions
from waitlens.sources.manifests import build_manifests, write_manifests


def load_history(
    spark: SparkSession,
    paths: Paths,
    extracts: Mapping[str, Callable[[], DataFrame]],
    start: date,
) -> DataFrame:
    """Land every entity's extract under the business dates of its rows.

    Extracts with a ``file_name`` are dated by it, others by the entity's business date,
    else by ``updated_at``; dates before ``start`` count as ``start``. Rows without a date
    go to a reject table beside the entity. Each source gets one manifest per date it
    landed, so a daily run knows where to go on. Returns (entity, landed, rejected).
    """
    run_id, started, totals, days = str(uuid.uuid4()), _now(), [], []
    for name, load in extracts.items():
        entity = ENTITIES[name]
        rows = coerce(load(), BACKFILL_TYPES.get(name, {}))
        if "file_name" in rows.columns:
            dated, rejected = backfill_by_file_name(rows, start)
        else:
            dated, rejected = backfill(rows, entity.business_date or "updated_at", start)
        # Landed and counted per date: compute the coercion once.
        dated = settle(dated)
        write_bronze(dated, paths.lake, entity)
        lost = settle(rejected.withColumn("ingest_date", F.lit(start)))
        kept_out = lost.count()
        if kept_out:
            write_partitions(lost, f"{bronze_path(paths.lake, entity)}_rejected")
        per_day = dated.groupBy("ingest_date").agg(F.count("*").alias("n"))
        days.append(
            per_day.select(
                F.lit(entity.source).alias("source"),
                "ingest_date",
                F.lit(run_id).alias("run_id"),
                F.lit(name).alias("item"),
                F.lit("success").alias("status"),
                F.lit(None).cast("string").alias("error"),
                F.lit(paths.env).alias("env"),
                F.lit(started).cast("timestamp_ntz").alias("started_at"),
                F.lit(_now()).cast("timestamp_ntz").alias("finished_at"),
                F.lit("historical load").alias("reason"),
                F.array(F.lit(name)).alias("inputs"),
                F.array(F.concat(F.lit(f"{name}/ingest_date="), F.col("ingest_date").cast("string"))).alias("outputs"),
            )
        )
        totals.append(per_day.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("landed")).select(F.lit(name).alias("entity"), "landed", F.lit(kept_out).cast("long").alias("rejected")))
    whole = days[0]
    for part in days[1:]:
        whole = whole.unionByName(part)
    write_manifests(build_manifests(whole), paths.manifests)
    result = totals[0]
    for part in totals[1:]:
        result = result.unionByName(part)
    return result
