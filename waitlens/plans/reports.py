"""Report queries on the star schema, and the shaping their charts need.

``Gold`` holds the tables; an empty provider or specialty list means no filter. Wait reports
read either the fact table or its cells (``wait_cells``), counts of equal values per site,
specialty and month: a quantile of any filter follows exactly from the counts of its values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.contracts import LONG_WAIT_DAYS, STRATIFIER_LABELS, STRATIFIERS
from waitlens.functions.temporal import month_label
from waitlens.operators.measures import quantiles, share

# Row order of the weekly heat map.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

_WAIT_POINTS = {"p50_wait": 0.5, "p90_wait": 0.9}


@dataclass(frozen=True)
class Gold:
    waits: DataFrame | None = None
    urgent: DataFrame | None = None
    inequality: DataFrame | None = None
    patients: DataFrame | None = None
    sites: DataFrame | None = None
    specialties: DataFrame | None = None


#: The column of a cell that says how many facts it stands for.
CELL_COUNT = "_cell_count"


def wait_cells(waits: DataFrame) -> DataFrame:
    """One row per site, specialty, month, wait and breach, with the number of facts.

    As many rows as there are distinct values, however many facts: to be stored with the
    export and given to the reports as ``Gold(waits=cells)``.
    """
    return waits.groupBy("site_sk", "specialty_sk", "treatment_month", "wait_days", "rtt_breach_flag").agg(
        F.count(F.lit(1)).alias(CELL_COUNT)
    )


def _facts(df: DataFrame) -> Column:
    """How many facts a row stands for."""
    return F.col(CELL_COUNT) if CELL_COUNT in df.columns else F.lit(1)


def _at_providers(
    facts: DataFrame, sites: DataFrame, providers: Sequence[str], need_name: bool = False
) -> DataFrame:
    """Facts of the named providers. The site table is joined only when it matters."""
    if not providers and not need_name:
        return facts
    named = sites.select("site_sk", "provider_name")
    if providers:
        named = named.where(F.col("provider_name").isin(*providers))
    return facts.join(named, "site_sk")


def _in_specialties(facts: DataFrame, specialties: DataFrame, wanted: Sequence[str]) -> DataFrame:
    if not wanted:
        return facts
    keys = specialties.where(F.col("specialty_name").isin(*wanted)).select("specialty_sk")
    return facts.join(keys, "specialty_sk")


def _waits(gold: Gold, providers: Sequence[str], specialties: Sequence[str], need_name: bool = False) -> DataFrame:
    return _in_specialties(
        _at_providers(gold.waits, gold.sites, providers, need_name), gold.specialties, specialties
    )


def wait_kpis(gold: Gold, providers: Sequence[str] = (), specialties: Sequence[str] = ()) -> DataFrame:
    """18-week breach rate, median wait, waits beyond 52 weeks.

    Facts collapse to one row per (wait, breach) before the median is taken.
    """
    facts = _waits(gold, providers, specialties)
    counts = facts.groupBy("wait_days", "rtt_breach_flag").agg(F.sum(_facts(facts)).alias("_n"))
    n = F.col("_n")
    return counts.agg(
        (F.sum(F.when(F.col("rtt_breach_flag"), n).otherwise(0)) / F.sum(n)).alias("breach_rate_18wk"),
        F.percentile("wait_days", F.lit(0.5), n).alias("median_wait_days"),
        F.coalesce(F.sum(F.when(F.col("wait_days") > LONG_WAIT_DAYS, n)), F.lit(0)).alias("waiters_52wk"),
    )


def wait_by_provider(gold: Gold, providers: Sequence[str] = (), specialties: Sequence[str] = ()) -> DataFrame:
    """Median and 90th percentile wait per provider."""
    facts = _waits(gold, providers, specialties, need_name=True)
    return quantiles(facts, ["provider_name"], "wait_days", _WAIT_POINTS, _facts(facts)).orderBy("provider_name")


def wait_trend(gold: Gold, providers: Sequence[str] = (), specialties: Sequence[str] = ()) -> DataFrame:
    """Median and 90th percentile wait per treatment month."""
    month = month_label(F.col("treatment_month")).alias("treatment_month")
    facts = _waits(gold, providers, specialties)
    return quantiles(facts, [month], "wait_days", _WAIT_POINTS, _facts(facts)).orderBy("treatment_month")


def month_bounds(gold: Gold) -> DataFrame:
    """First and last treatment month, unfiltered."""
    return gold.waits.agg(
        F.min("treatment_month").alias("a"), F.max("treatment_month").alias("b")
    ).select(month_label(F.col("a")).alias("min_month"), month_label(F.col("b")).alias("max_month"))


def month_range(trend: DataFrame, first: str, last: str, col: str = "treatment_month") -> DataFrame:
    """Trend rows of an inclusive month range."""
    return trend.where(F.col(col).between(first, last))


def inequality_kpis(gold: Gold, metric: str = "wait_time_median") -> DataFrame:
    """Latest slope index, widest gap over deciles 1 and 10, number of suppressed cells.

    The gap spans all periods: it is not a same-month difference.
    """
    ordered = F.col("stratifier") == "imd_decile"
    ends = ordered & F.col("stratum").isin("1", "10")
    latest = F.struct(F.col("period").isNotNull().alias("known"), F.col("period").alias("at"))
    value = F.when(ends, F.col("metric_value"))
    return (
        gold.inequality.where(F.col("metric_name") == metric)
        .agg(
            F.max(F.when(ordered, F.struct(latest.alias("k"), F.col("sii_value").alias("v"))))["v"].alias("sii"),
            (F.max(value) - F.min(value)).alias("imd_gap"),
            F.count_if(F.col("population_count").isNull()).alias("suppressed_count"),
        )
    )


def strata_of(gold: Gold, stratifier: str) -> DataFrame:
    """Metric values of one stratifier."""
    if stratifier not in STRATIFIERS:
        raise ValueError(f"unknown stratifier: {stratifier!r}")
    return (
        gold.inequality.where(F.col("stratifier") == stratifier)
        .select(
            "metric_name", "period", "stratum", "population_count", "metric_value", "sii_value", "rii_value"
        )
        .orderBy("metric_name", "stratum")
    )


def _urgent(gold: Gold, providers: Sequence[str], need_name: bool = False) -> DataFrame:
    return _at_providers(gold.urgent, gold.sites, providers, need_name)


def _urgent_rates() -> list[Column]:
    return [
        share(F.col("four_hour_breach_flag")).alias("breach_rate_4h"),
        F.count_if("twelve_hour_breach_flag").alias("breach_count_12h"),
        share(F.col("admitted_flag")).alias("admission_rate"),
    ]


def _stage_means() -> list[Column]:
    triage, seen, out = (
        F.avg(f"arrival_to_{s}_mins") for s in ("triage", "seen", "discharge")
    )
    return [
        triage.alias("avg_triage"),
        (seen - triage).alias("avg_seen"),
        (out - seen).alias("avg_discharge"),
    ]


def urgent_kpis(gold: Gold, providers: Sequence[str] = ()) -> DataFrame:
    """4-hour breach rate, 12-hour breaches, admission rate."""
    return _urgent(gold, providers).agg(*_urgent_rates())


def stage_times(gold: Gold, providers: Sequence[str] = ()) -> DataFrame:
    """Mean minutes in each stage per provider."""
    facts = _urgent(gold, providers, need_name=True)
    return facts.groupBy("provider_name").agg(*_stage_means()).orderBy("provider_name")


def breach_trend(gold: Gold, providers: Sequence[str] = ()) -> DataFrame:
    """4-hour breach rate per arrival month."""
    rate = share(F.col("four_hour_breach_flag")).alias("breach_rate_4h")
    return _urgent(gold, providers).groupBy("arrival_month").agg(rate).orderBy("arrival_month")


def busiest_hours(gold: Gold, providers: Sequence[str] = ()) -> DataFrame:
    """Attendances per weekday and hour."""
    at = F.col("arrival_datetime")
    return (
        _urgent(gold, providers)
        .groupBy(F.date_format(at.cast("date"), "EEEE").alias("day_of_week"), F.hour(at).alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("attendance_count"))
        .orderBy("day_of_week", "hour_of_day")
    )


def urgent_equity(gold: Gold, label: str, providers: Sequence[str] = ()) -> DataFrame:
    """Urgent-care measures split by a demographic attribute of current patients."""
    if label not in STRATIFIER_LABELS:
        raise ValueError(f"unknown stratifier: {label!r}")
    column = STRATIFIER_LABELS[label]
    who = gold.patients.where("is_current").select("patient_sk", F.col(column).alias("stratum"))
    return (
        _urgent(gold, providers)
        .join(who, "patient_sk")
        .groupBy("stratum")
        .agg(*_urgent_rates(), *_stage_means(), F.count(F.lit(1)).alias("attendance_count"))
        .orderBy("stratum")
    )


def provider_options(gold: Gold) -> DataFrame:
    """Providers that have waiting-time facts."""
    used = gold.waits.select("site_sk").distinct()
    return used.join(gold.sites, "site_sk").select("provider_name").distinct().orderBy("provider_name")


def site_options(gold: Gold) -> DataFrame:
    return gold.sites.select("provider_name").distinct().orderBy("provider_name")


def specialty_options(gold: Gold) -> DataFrame:
    return gold.specialties.select("specialty_name").distinct().orderBy("specialty_name")


def month_options(gold: Gold) -> DataFrame:
    months = gold.waits.select("treatment_month").where("treatment_month IS NOT NULL").distinct()
    return months.select(month_label(F.col("treatment_month")).alias("month")).distinct().orderBy("month")


def mean_over_periods(strata: DataFrame, *by: str) -> DataFrame:
    """Unweighted mean of the monthly values per stratum (or per metric and stratum)."""
    value = F.col("metric_value").cast("string").try_cast("double")
    return strata.groupBy(*by).agg(F.avg(value).alias("metric_value"))


def scaled_within(df: DataFrame, group: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """Min-max scale to 0..1 within a group; 0.5 when the group is flat. Drops NULLs."""
    over = Window.partitionBy(group)
    low, high = F.min(value).over(over), F.max(value).over(over)
    scaled = F.when(low == high, F.lit(0.5)).otherwise((F.col(value) - low) / (high - low))
    return df.where(F.col(value).isNotNull()).withColumn("normalized", scaled)


def deviation_from_mean(df: DataFrame, value: str = "metric_value", within: str | None = None) -> DataFrame:
    """Difference from the unweighted mean of all rows, or of those equal in ``within``.

    The rows are the strata of one stratifier, a fixed vocabulary, so one window holds them.
    """
    rows = df.where(F.col(value).isNotNull())
    group = Window.partitionBy(*[within] * (within is not None))
    return rows.withColumn("deviation", F.col(value) - F.avg(value).over(group))


def heat_matrix(hours: DataFrame) -> DataFrame:
    """Weekday x hour matrix, Monday first, columns ``00:00`` to ``23:00``."""
    labelled = hours.withColumn("_hour", F.format_string("%02d:00", "hour_of_day"))
    matrix = (
        labelled.groupBy("day_of_week")
        .pivot("_hour", [f"{h:02d}:00" for h in range(24)])
        .agg(F.sum("attendance_count"))
    )
    order = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("day_of_week"))
    return matrix.withColumn("day_order", order.cast("int")).orderBy("day_order")


def hour_labels(values: Sequence[int]) -> list[str]:
    """Axis labels: ``HH:00`` when the values are hours of a day, plain numbers otherwise."""
    hourly = bool(values) and all(0 <= v <= 23 for v in values) and max(values) > 10
    return [f"{v:02d}:00" if hourly else str(v) for v in values]


def suppression_marks(df: DataFrame, value: str = "metric_value") -> DataFrame:
    """Bar height (0 for a hidden value) and whether the bar is a hidden one."""
    return df.withColumn("suppressed", F.col(value).isNull()).withColumn(
        "bar_value", F.coalesce(F.col(value), F.lit(0.0))
    )


def as_percent(df: DataFrame, *columns: str) -> DataFrame:
    """Rates as percentages; unknown becomes 0."""
    scaled = {
        c: F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)) * 100.0 for c in columns
    }
    return df.withColumns(scaled)
