"""Readiness of Bronze for conforming: seven checks over a set of entities.

Every check yields rows (check_name, entity, passed, detail). Entities are given as a
mapping; one that is not in it is missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.contracts import ENTITIES, FOREIGN_KEYS, JOIN_KEY_HOLDERS, TEXT_KEY_ENTITIES, Entity
from waitlens.operators.profiling import is_time

ROW_DDL = "check_name string, entity string, passed boolean, detail string"
Frames = Mapping[str, DataFrame]


def _stack(spark: SparkSession, parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ROW_DDL)


def _result(check: str, entity: str, passed: Column, detail: Column) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        F.lit(entity).alias("entity"),
        passed.alias("passed"),
        detail.alias("detail"),
    ]


def _fixed(spark: SparkSession, check: str, entity: str, passed: bool, detail: str) -> DataFrame:
    return spark.range(1).select(*_result(check, entity, F.lit(passed), F.lit(detail)))


def completeness(spark: SparkSession, frames: Frames, entities: Mapping[str, Entity] = ENTITIES) -> DataFrame:
    """Every registered entity is present and has rows."""
    parts = []
    for name in entities:
        if name not in frames:
            parts.append(_fixed(spark, "entity_completeness", name, False, "entity missing"))
            continue
        n = frames[name].agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            n.select(
                *_result(
                    "entity_completeness",
                    name,
                    F.col("n") > 0,
                    F.concat(F.lit("rows="), F.col("n").cast("string")),
                )
            )
        )
    return _stack(spark, parts)


def primary_keys(spark: SparkSession, frames: Frames, entities: Mapping[str, Entity] = ENTITIES) -> DataFrame:
    """Keys are unique and never NULL; a second NULL counts as a duplicate too."""
    parts = []
    for name, entity in entities.items():
        df = frames.get(name)
        if df is None:
            continue
        if entity.pk not in df.columns:
            detail = f"key column {entity.pk} not found"
            parts.append(_fixed(spark, "pk_unique_nonnull", name, False, detail))
            continue
        groups = df.groupBy(entity.pk).agg(F.count(F.lit(1)).alias("_n"))
        counts = groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("keys"),
            F.coalesce(F.sum(F.when(F.col(entity.pk).isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
        ).where("rows > 0")
        duplicates = F.col("rows") - F.col("keys")
        parts.append(
            counts.select(
                *_result(
                    "pk_unique_nonnull",
                    name,
                    (F.col("nulls") == 0) & (duplicates == 0),
                    F.format_string("nulls=%d, duplicates=%d, rows=%d", "nulls", duplicates, "rows"),
                )
            )
        )
    return _stack(spark, parts)


def join_keys_present(spark: SparkSession, frames: Frames) -> DataFrame:
    """The columns entities are joined on exist. Reads schemas only."""
    parts = [
        _fixed(
            spark,
            "join_key_existence",
            name,
            key in frames[name].columns,
            f"column={key} present={key in frames[name].columns}",
        )
        for key, holders in JOIN_KEY_HOLDERS.items()
        for name in holders
        if name in frames
    ]
    return _stack(spark, parts)


def null_rates(spark: SparkSession, frames: Frames, entities: Mapping[str, Entity] = ENTITIES) -> DataFrame:
    """Any NULL in a key fails; over half NULL elsewhere warns; the rest is silent."""
    parts = []
    for name, entity in entities.items():
        df = frames.get(name)
        if df is None:
            continue
        critical = {entity.pk, *entity.join_keys}
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
        )
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("c"), F.lit(c in critical).alias("critical"), F.col(f"_{i}").alias("n")
                )
                for i, c in enumerate(df.columns)
            ]
        )
        share = F.col("n") * 100.0 / F.nullif(F.col("_rows"), F.lit(0))
        found = counts.select("_rows", F.inline(cells)).where(
            F.when(F.col("critical"), F.col("n") > 0).otherwise(share > 50.0)
        )
        parts.append(
            found.select(
                *_result(
                    "null_rate",
                    name,
                    ~F.col("critical"),
                    F.format_string(
                        "%scolumn=%s nulls=%d",
                        F.when(F.col("critical"), "").otherwise("WARN "),
                        "c",
                        "n",
                    ),
                )
            )
        )
    return _stack(spark, parts)


def key_types(spark: SparkSession, frames: Frames) -> DataFrame:
    """A key has one type across entities; entities known to use text only warn."""
    parts = []
    for key, holders in JOIN_KEY_HOLDERS.items():
        types = {
            name: frames[name].schema[key].dataType.simpleString()
            for name in holders
            if name in frames and key in frames[name].columns
        }
        if len(set(types.values())) <= 1:
            continue
        for name, kind in types.items():
            known = name in TEXT_KEY_ENTITIES and kind == "string"
            detail = f"{'WARN ' if known else ''}column={key} type={kind}"
            parts.append(_fixed(spark, "type_consistency", name, known, detail))
    return _stack(spark, parts)


def references(
    spark: SparkSession,
    frames: Frames,
    rules: Sequence[tuple[str, str, str, str]] = FOREIGN_KEYS,
) -> DataFrame:
    """Distinct child keys without a parent, compared as text."""
    parts = []
    for child, column, parent, parent_column in rules:
        if child not in frames or parent not in frames:
            continue
        target = f"{column} -> {parent}.{parent_column}"
        if column not in frames[child].columns or parent_column not in frames[parent].columns:
            parts.append(
                _fixed(spark, "referential_integrity", child, False, f"{target}: column missing")
            )
            continue
        have = _distinct_text(frames[child], column)
        known = _distinct_text(frames[parent], parent_column).withColumn("_known", F.lit(True))
        counts = have.join(known, "_key", "left").agg(
            F.count(F.lit(1)).alias("total"), F.count_if(F.col("_known").isNull()).alias("orphans")
        )
        parts.append(
            counts.select(
                *_result(
                    "referential_integrity",
                    child,
                    F.col("orphans") == 0,
                    F.format_string(f"{target}: orphans=%d/%d", "orphans", "total"),
                )
            )
        )
    return _stack(spark, parts)


def _distinct_text(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("_key")).distinct()


def date_overlap(spark: SparkSession, frames: Frames, entities: Mapping[str, Entity] = ENTITIES) -> DataFrame:
    """At least three entities share a date range.

    One row per entity with a range, then one for all: the shared range runs from the
    latest start to the earliest end.
    """
    ranges = []
    for name in entities:
        if name not in frames:
            continue
        times = [f.name for f in frames[name].schema.fields if is_time(f.dataType)]
        if not times:
            continue
        ends = frames[name].agg(
            *[F.min(c).cast("timestamp_ntz").alias(f"lo{i}") for i, c in enumerate(times)],
            *[F.max(c).cast("timestamp_ntz").alias(f"hi{i}") for i, c in enumerate(times)],
        )
        lows = F.array_min(F.array(*[F.col(f"lo{i}") for i in range(len(times))]))
        highs = F.array_max(F.array(*[F.col(f"hi{i}") for i in range(len(times))]))
        ranges.append(
            ends.select(F.lit(name).alias("entity"), lows.alias("lo"), highs.alias("hi")).where(
                "lo IS NOT NULL"
            )
        )
    if not ranges:
        return _fixed(spark, "date_range_coverage", "all", False, "entities_with_dates=0")
    spans = reduce(DataFrame.unionByName, ranges)
    # One row per entity at most, so gathering them into one array is bounded.
    gathered = spans.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("lo").alias("start"),
        F.min("hi").alias("end"),
        F.collect_list(F.struct("entity", "lo", "hi")).alias("spans"),
    )
    covers = lambda s: (s["lo"] <= F.col("end")) & (s["hi"] >= F.col("start"))
    covering = F.size(F.filter("spans", covers))
    per_entity = F.transform(
        "spans",
        lambda s: F.struct(
            s["entity"].alias("entity"),
            covers(s).alias("passed"),
            F.concat(
                F.lit("range="),
                s["lo"].cast("date").cast("string"),
                F.lit(" to "),
                s["hi"].cast("date").cast("string"),
            ).alias("detail"),
        ),
    )
    overall = F.struct(
        F.lit("all").alias("entity"),
        (
            (F.col("n") >= 3) & (F.col("start") <= F.col("end")) & (covering >= 3)
        ).alias("passed"),
        F.when(
            F.col("n") < 3, F.concat(F.lit("entities_with_dates="), F.col("n").cast("string"))
        )
        .otherwise(F.concat(F.lit("overlapping_entities="), covering.cast("string")))
        .alias("detail"),
    )
    rows = F.when(F.col("n") < 3, F.array(overall)).otherwise(F.concat(per_entity, F.array(overall)))
    return gathered.select(F.inline(rows)).select(
        F.lit("date_range_coverage").alias("check_name"), "entity", "passed", "detail"
    )


def readiness_report(spark: SparkSession, frames: Frames) -> DataFrame:
    """All seven checks, one row each finding."""
    return _stack(
        spark,
        [
            completeness(spark, frames),
            primary_keys(spark, frames),
            join_keys_present(spark, frames),
            null_rates(spark, frames),
            key_types(spark, frames),
            references(spark, frames),
            date_overlap(spark, frames),
        ],
    )


def readiness_verdict(report: DataFrame) -> DataFrame:
    """Totals of a report and whether Bronze is ready."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    ).select("*", (F.col("failed") == 0).alias("ready"))
