"""Column and entity profiles and the gaps they reveal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from waitlens.contracts import Entity


def is_time(kind: DataType) -> bool:
    return isinstance(kind, (TimestampType, TimestampNTZType))


def _ranged(kind: DataType) -> bool:
    return isinstance(kind, NumericType) or is_time(kind)


def column_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, filled share, distinct count and range of every column.

    Counts and ranges come from one aggregation over one scan. Exact distinct counts
    are taken one column at a time, each from its grouped values, so no row is copied
    once per column; ``approximate`` puts a sketch for each column in the one scan.
    """
    fields = df.schema.fields
    aggregates: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        aggregates.append(F.count(F.col(f.name)).alias(f"_n{i}"))
        if _ranged(f.dataType):
            aggregates += [F.min(f.name).alias(f"_lo{i}"), F.max(f.name).alias(f"_hi{i}")]
        if approximate:
            aggregates.append(F.approx_count_distinct(f.name).alias(f"_d{i}"))
    rows = []
    for i, f in enumerate(fields):
        ranged = _ranged(f.dataType)
        filled = F.coalesce(
            F.col(f"_n{i}") * F.lit(100.0) / F.nullif(F.col("_rows"), F.lit(0)), F.lit(0.0)
        )
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                filled.alias("non_null_pct"),
                (F.col(f"_d{i}") if approximate else F.lit(None).cast("bigint")).alias(
                    "distinct_count"
                ),
                (F.col(f"_lo{i}").cast("string") if ranged else F.lit(None).cast("string")).alias(
                    "min_value"
                ),
                (F.col(f"_hi{i}").cast("string") if ranged else F.lit(None).cast("string")).alias(
                    "max_value"
                ),
            )
        )
    profile = df.agg(*aggregates).select(F.inline(F.array(*rows)))
    if approximate:
        return profile
    counts = [
        df.where(F.col(f.name).isNotNull())
        .groupBy(f.name)
        .agg(F.lit(1).alias("_one"))
        .agg(F.count(F.lit(1)).alias("distinct_count"))
        .select(F.lit(f.name).alias("column_name"), "distinct_count")
        for f in fields
    ]
    return (
        profile.drop("distinct_count")
        .join(reduce(DataFrame.unionByName, counts), "column_name")
        .select("column_name", "data_type", "non_null_pct", "distinct_count", "min_value", "max_value")
    )


def entity_profile(df: DataFrame, name: str, pk: str, source: str) -> DataFrame:
    """Rows, key uniqueness, NULL keys and overall timestamp range of one entity."""
    times = [f.name for f in df.schema.fields if is_time(f.dataType)]
    lows = [F.min(c).alias(f"_lo_{c}") for c in times]
    highs = [F.max(c).alias(f"_hi_{c}") for c in times]
    base = df.groupBy(pk).agg(F.count(F.lit(1)).alias("_n"), *lows, *highs)
    nothing = F.lit(None).cast("timestamp_ntz")
    merged = base.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count(pk).alias("_distinct"),
        F.coalesce(F.sum(F.when(F.col(pk).isNull(), F.col("_n"))), F.lit(0)).alias("pk_null_count"),
        *[F.min(f"_lo_{c}").alias(f"_lo_{c}") for c in times],
        *[F.max(f"_hi_{c}").alias(f"_hi_{c}") for c in times],
    )

    def overall(pick, side: str) -> Column:
        ends = [F.col(f"_{side}_{c}").cast("timestamp_ntz") for c in times]
        return pick(*ends) if len(ends) > 1 else (ends[0] if ends else nothing)

    return merged.select(
        F.lit(name).alias("entity"),
        F.lit(source).alias("source"),
        "row_count",
        F.lit(pk).alias("pk"),
        (F.col("_distinct") == F.col("row_count") - F.col("pk_null_count")).alias("pk_unique"),
        "pk_null_count",
        overall(F.least, "lo").alias("range_start"),
        overall(F.greatest, "hi").alias("range_end"),
    )


def gap_rows(columns: DataFrame, summary: DataFrame, entity: Entity) -> DataFrame:
    """Findings on one entity: text timestamps, sparse columns, key problems, no rows."""
    name = F.lit(entity.name).alias("entity")
    late_types = columns.where(
        F.col("column_name").isin(*entity.text_timestamps) & ~F.col("data_type").like("timestamp%")
    ).select(name, F.lit("type_mismatch").alias("gap"), "column_name", F.col("data_type").alias("detail"))
    sparse = columns.where(F.col("non_null_pct") < 90.0).select(
        name,
        F.lit("high_nulls").alias("gap"),
        "column_name",
        F.concat(
            F.round(100.0 - F.col("non_null_pct"), 1).cast("string"),
            F.lit("% nulls, "),
            F.col("distinct_count").cast("string"),
            F.lit(" distinct"),
        ).alias("detail"),
    )
    key = F.lit(entity.pk).alias("column_name")
    findings = F.array(
        F.struct(
            F.lit(bool(entity.join_keys)).alias("holds"),
            F.lit("join_keys").alias("gap"),
            F.lit(None).cast("string").alias("column_name"),
            F.lit(",".join(entity.join_keys)).alias("detail"),
        ),
        F.struct(
            (~F.col("pk_unique")).alias("holds"),
            F.lit("pk_duplicates").alias("gap"),
            key,
            F.lit("deduplicate when conforming").alias("detail"),
        ),
        F.struct(
            (F.col("pk_null_count") > 0).alias("holds"),
            F.lit("pk_nulls").alias("gap"),
            key,
            F.col("pk_null_count").cast("string").alias("detail"),
        ),
        F.struct(
            (F.col("row_count") == 0).alias("holds"),
            F.lit("no_rows").alias("gap"),
            F.lit(None).cast("string").alias("column_name"),
            F.lit("check the ingestion").alias("detail"),
        ),
    )
    whole = (
        summary.select(F.inline(findings)).where("holds").select(name, "gap", "column_name", "detail")
    )
    return late_types.unionByName(sparse).unionByName(whole)
