"""Dimension operators: calendar, dense surrogate keys, validity intervals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waitlens.operators.conform import dedup_latest
from waitlens.session import settle


def calendar(
    spark: SparkSession, first: date = date(2020, 1, 1), last: date = date(2030, 12, 31)
) -> DataFrame:
    """One row per day with its parts; the week starts on Sunday = 0."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last))).alias("calendar_date")
    )
    day = F.col("calendar_date")
    weekday = F.dayofweek(day) - 1
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "MMM yyyy").alias("month_label"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def dense_key(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..n in ``order_by`` order without a single-task sort.

    The rows are range-partitioned and settled, so the partition of a row is fixed.
    Only the row count per partition is gathered; its running total shifts the
    row numbers inside each partition.
    """
    order = [F.col(c).asc_nulls_last() for c in order_by]
    placed = settle(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_part").orderBy(*order)
    numbered = placed.withColumn("_row", F.row_number().over(within)).join(offsets, "_part")
    return numbered.select(
        (F.col("_offset") + F.col("_row")).cast("bigint").alias(name), *df.columns
    )


def validity(df: DataFrame, start: str, end: str) -> DataFrame:
    """Open-ended validity interval: ``valid_from``, ``valid_to``, ``is_current``."""
    return (
        df.withColumn("valid_from", F.col(start))
        .withColumn("valid_to", F.coalesce(F.col(end), F.lit(date(9999, 12, 31))))
        .withColumn("is_current", F.col(end).isNull())
    )


def versions(
    df: DataFrame, key: str, attributes: Sequence[str], at: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """(key, attributes, valid_from, valid_to, is_current) from successive deliveries.

    A new interval starts where an attribute changes and ends where the next one starts;
    deliveries that repeat the state open none. Of deliveries at one instant the highest by
    ``tiebreak``, then by the attributes, counts. The last interval is open: ``valid_to`` is
    NULL. Intervals include their start and exclude their end. Rows without key or instant
    have no place in time and are left out.
    """
    placed = df.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    last = dedup_latest(placed.select(key, at, *attributes, *tiebreak), [key, at], list(tiebreak), list(attributes))
    in_time = Window.partitionBy(key).orderBy(at)
    state = F.struct(*attributes)
    before = F.lag(state).over(in_time)
    changed = last.withColumn("_new", before.isNull() | ~state.eqNullSafe(before)).where("_new")
    until = F.lead(at).over(in_time)
    return changed.select(key, *attributes, F.col(at).alias("valid_from"), until.alias("valid_to")).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def as_of(
    facts: DataFrame, dimension: DataFrame, key: str, at: str, columns: Sequence[str], dimension_key: str | None = None
) -> DataFrame:
    """Facts with ``columns`` of the version of their key that was valid at ``at``.

    Intervals of a key do not overlap, so a fact meets one version at most; it stays with
    NULLs where there is none. The join is by key, with the interval as a condition: its
    work is a key's facts times its versions, and a hot key's facts are split by the
    adaptive join. Facts without key or instant are scattered, not sent to one task.
    """
    right = dimension.select(
        F.col(dimension_key or key).alias("_vkey"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *columns
    )
    match = (
        (F.col(key) == F.col("_vkey"))
        & (F.col(at) >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    )
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    none = [F.lit(None).cast(dimension.schema[c].dataType).alias(c) for c in columns]
    met = facts.where(known).join(right, match, "left").drop("_vkey", "_from", "_to")
    return met.unionByName(facts.where(~known).select("*", *none))
