"""Stratified metrics, ridit scores, slope and relative indices, small-cell suppression."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAIN = ("metric_name", "period", "stratifier", "stratum")


def _by_stratifier(cells: DataFrame, stratifiers: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """Long form of the stratifier columns; a NULL stratum stays a stratum."""
    text = cells.select(*rest, *[F.col(s).cast("string").alias(s) for s in stratifiers])
    return text.unpivot(list(rest), list(stratifiers), "stratifier", "stratum")


def stratified_median(
    events: DataFrame, metric: str, period: str, value: str, stratifiers: Sequence[str]
) -> DataFrame:
    """Median of ``value`` per period, stratifier and stratum; NULL values do not count.

    One scan: events collapse to counts per (period, all strata, value), and only those
    counts are repeated for each stratifier.
    """
    cells = (
        events.where(F.col(value).isNotNull())
        .groupBy(F.col(period).alias("period"), *stratifiers, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = (
        _by_stratifier(cells, stratifiers, ["period", "_value", "_n"])
        .groupBy("period", "stratifier", "stratum", "_value")
        .agg(F.sum("_n").alias("_n"))
    )
    return counts.groupBy("period", "stratifier", "stratum").agg(
        F.sum("_n").alias("population_count"),
        F.percentile("_value", F.lit(0.5), F.col("_n")).alias("metric_value"),
    ).select(F.lit(metric).alias("metric_name"), "period", "stratifier", "stratum",
             "population_count", "metric_value")


def stratified_rate(
    events: DataFrame, metric: str, period: str, hit: Column, stratifiers: Sequence[str]
) -> DataFrame:
    """Share of events with ``hit`` per period, stratifier and stratum, in one scan."""
    cells = events.groupBy(F.col(period).alias("period"), *stratifiers).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(hit).alias("_hits")
    )
    return (
        _by_stratifier(cells, stratifiers, ["period", "_n", "_hits"])
        .groupBy("period", "stratifier", "stratum")
        .agg(F.sum("_n").alias("population_count"), F.sum("_hits").alias("_hits"))
        .select(
            F.lit(metric).alias("metric_name"),
            "period",
            "stratifier",
            "stratum",
            "population_count",
            (F.col("_hits").cast("double") / F.col("population_count")).alias("metric_value"),
        )
    )


def union_metrics(metrics: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, metrics)


def with_ridit(df: DataFrame, ordered: str = "imd_decile") -> DataFrame:
    """Ridit score and population weight of each stratum of the ordered stratifier.

    Strata rank ascending by number, so 1 (most deprived) comes first and an unknown
    stratum last. Windows run over strata, of which a (metric, period) has a handful.
    """
    group = Window.partitionBy("metric_name", "period", "stratifier")
    rank = F.when(F.col("stratifier") == ordered, F.col("stratum").try_cast("int"))
    so_far = group.orderBy(rank.asc_nulls_last(), F.col("stratum").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    size = F.col("population_count").cast("double")
    total = F.nullif(F.sum(size).over(group), F.lit(0.0))
    applies = F.col("stratifier") == ordered
    return df.select(
        "*",
        F.when(applies, (F.sum(size).over(so_far) - 0.5 * size) / total).alias("ridit_score"),
        F.when(applies, size / total).alias("weight"),
    )


def with_slope_indices(
    df: DataFrame, method: str = "reference", affluence_positive: bool = True
) -> DataFrame:
    """Slope (SII) and relative (RII) index of inequality per metric and period.

    ``method="wls"`` is the weighted least-squares slope of the metric on the ridit
    score. ``method="reference"`` keeps the published formula, which multiplies by the
    number of strata where least squares has the sum of weights (one).
    The slope is positive when the metric rises with affluence; ``affluence_positive=False``
    flips the sign. All sums are windows over one group's strata: no join back, and the
    same partitioning as ``with_ridit``.
    """
    if method not in ("reference", "wls"):
        raise ValueError(f"unknown method: {method!r}")
    group = Window.partitionBy("metric_name", "period", "stratifier")
    w, x, y = F.col("weight"), F.col("ridit_score"), F.col("metric_value").cast("double")
    size = F.col("population_count").cast("double")
    total = lambda c: F.sum(c).over(group)
    n = F.count(F.lit(1)).over(group).cast("double") if method == "reference" else total(w)
    slope = (n * total(w * x * y) - total(w * x) * total(w * y)) / F.nullif(
        n * total(w * x * x) - F.pow(total(w * x), F.lit(2.0)), F.lit(0.0)
    )
    if not affluence_positive:
        slope = -slope
    mean = F.nullif(total(size * y) / F.nullif(total(size), F.lit(0.0)), F.lit(0.0))
    applies = x.isNotNull() & F.col("period").isNotNull()
    return df.select(
        "*", F.when(applies, slope).alias("sii_value"), F.when(applies, mean).alias("_mean")
    ).select(*df.columns, "sii_value", (F.col("sii_value") / F.col("_mean")).alias("rii_value"))


def suppress_small(
    df: DataFrame, columns: Sequence[str], count: str = "population_count", below: int = 5
) -> DataFrame:
    """NULL the named columns of every row that counts fewer than ``below``."""
    enough = F.col(count) >= below
    return df.select(
        *[F.when(enough, F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )
