"""Facts and inequality statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.contracts import STRATIFIERS
from waitlens.operators.inequality import (
    stratified_median,
    stratified_rate,
    suppress_small,
    union_metrics,
    with_ridit,
    with_slope_indices,
)
from waitlens.operators.measures import (
    contains_flag,
    first_match,
    interval_breach,
    milestones,
    stage_minutes,
    status_flag,
)
from waitlens.plans import gold
from workload.registry import query, rounded
from workload.roles import Roles


@query(
    "d1_first_match",
    """SELECT r.referral_id, CAST(t.started AS DATE) AS treatment_date, t.gap FROM s_referrals r LEFT JOIN first_treatment t ON t.referral_id=r.referral_id""",
)
def d1(r: Roles) -> DataFrame:
    requests = r.s_referrals.select(
        "referral_id", "patient_sk", F.col("referral_datetime").cast("date").alias("day")
    )
    events = r.s_encounters.where("was_attended")
    matched = first_match(
        requests, events, "patient_sk", "day", "encounter_datetime_start", "wait_time_days"
    )
    return matched.select(
        "referral_id", F.col("matched_at").cast("date").alias("treatment_date"),
        F.col("matched_gap").alias("gap"),
    )


@query("d2_milestones", "SELECT referral_id, asked AS dm01_request_date, answered AS dm01_result_date FROM first_tests")
def d2(r: Roles) -> DataFrame:
    return milestones(
        r.s_diagnostics,
        "referral_id",
        "request_date",
        {"dm01_request_date": "request_date", "dm01_result_date": "result_date"},
    )


@query(
    "d3_interval_breach",
    """SELECT diagnostic_id, CAST(datediff('day', request_date, result_date) AS INT) AS wait,
         coalesce(datediff('day', request_date, result_date) > 42, FALSE) AS breach FROM s_diagnostics""",
)
def d3(r: Roles) -> DataFrame:
    timed = interval_breach(r.s_diagnostics, "request_date", "result_date", 42, "wait", "breach")
    return timed.select("diagnostic_id", "wait", "breach")


@query("d4_fct_wait_times", "SELECT * FROM fct_wait_times")
def d4(r: Roles) -> DataFrame:
    return r.waits


@query(
    "d5_stage_minutes",
    """SELECT uc_log_id, datediff('minute', arrival_datetime, triage_datetime) AS triage,
         datediff('minute', arrival_datetime, seen_by_clinician_datetime) AS seen,
         datediff('minute', arrival_datetime, departure_datetime) AS stay FROM b_urgent""",
)
def d5(r: Roles) -> DataFrame:
    stages = {
        "triage": "triage_datetime", "seen": "seen_by_clinician_datetime", "stay": "departure_datetime",
    }
    return stage_minutes(r.urgent_care_logs, "arrival_datetime", stages).select("uc_log_id", *stages)


@query("d6_fct_urgent_care", "SELECT * FROM fct_urgent_care")
def d6(r: Roles) -> DataFrame:
    return r.urgent


@query(
    "d7_status_flags",
    """SELECT appointment_id, booking_updated_datetime, coalesce(booking_status='DNA',FALSE) AS dna,
         coalesce(booking_status='attended',FALSE) AS attended, coalesce(booking_status LIKE '%cancel%',FALSE) AS cancelled
       FROM b_appointments""",
)
def d7(r: Roles) -> DataFrame:
    status = F.col("booking_status")
    return r.appointments.select(
        "appointment_id",
        "booking_updated_datetime",
        status_flag(status, "DNA").alias("dna"),
        status_flag(status, "attended").alias("attended"),
        contains_flag(status, "cancel").alias("cancelled"),
    )


@query("d8_fct_utilisation", "SELECT * FROM fct_utilisation")
def d8(r: Roles) -> DataFrame:
    return r.utilisation


@query(
    "d9_stratified_metrics",
    "SELECT metric_name, period, stratifier, stratum, population_count, round(metric_value,6) AS metric_value FROM metrics",
)
def d9(r: Roles) -> DataFrame:
    return rounded(_metrics(r), "metric_value")


def _metrics(r: Roles) -> DataFrame:
    """All three metrics over all strata."""
    return gold.inequality_base(*r.inequality_facts)


@query(
    "d10_ridit",
    """SELECT metric_name, period, stratifier, stratum, population_count, round(ridit_score,6) AS ridit_score, round(weight,6) AS weight
       FROM ridits""",
)
def d10(r: Roles) -> DataFrame:
    return rounded(with_ridit(_metrics(r)), "ridit_score", "weight").drop("metric_value")


@query(
    "d11_sii",
    "SELECT metric_name, period, round(sii_value,6) AS sii_value FROM slopes",
)
def d11(r: Roles) -> DataFrame:
    indexed = with_slope_indices(with_ridit(_metrics(r))).where("stratifier = 'imd_decile'")
    return rounded(
        indexed.groupBy("metric_name", "period").agg(F.max("sii_value").alias("sii_value")), "sii_value"
    )


@query(
    "d11_sii_wls",
    """SELECT metric_name, period, round(
         (sum(weight*ridit_score*metric_value) - sum(weight*ridit_score)*sum(weight*metric_value))
         / nullif(sum(weight*ridit_score*ridit_score) - power(sum(weight*ridit_score),2),0), 6) AS sii_value
       FROM ridits WHERE stratifier='imd_decile' GROUP BY 1,2""",
)
def d11_wls(r: Roles) -> DataFrame:
    indexed = with_slope_indices(with_ridit(_metrics(r)), method="wls").where("stratifier = 'imd_decile'")
    return rounded(
        indexed.groupBy("metric_name", "period").agg(F.max("sii_value").alias("sii_value")), "sii_value"
    )


@query(
    "d12_rii",
    "SELECT metric_name, period, round(rii_value,6) AS rii_value FROM slopes",
)
def d12(r: Roles) -> DataFrame:
    indexed = with_slope_indices(with_ridit(_metrics(r))).where("stratifier = 'imd_decile'")
    return rounded(
        indexed.groupBy("metric_name", "period").agg(F.max("rii_value").alias("rii_value")), "rii_value"
    )


@query(
    "d13_suppression",
    """SELECT metric_name, period, stratifier, stratum, CASE WHEN population_count>=5 THEN population_count END AS population_count,
         round(CASE WHEN population_count>=5 THEN metric_value END,6) AS metric_value
       FROM metrics""",
)
def d13(r: Roles) -> DataFrame:
    hidden = suppress_small(_metrics(r), ["population_count", "metric_value"])
    return rounded(hidden, "metric_value")


@query(
    "d14_fct_inequality",
    """SELECT metric_name, period, stratifier, stratum, population_count, round(metric_value,6) AS metric_value,
         round(ridit_score,6) AS ridit_score, round(sii_value,6) AS sii_value, round(rii_value,6) AS rii_value FROM fct_inequality""",
)
def d14(r: Roles) -> DataFrame:
    return rounded(r.inequality, "metric_value", "ridit_score", "sii_value", "rii_value")


@query(
    "d14_quantity_inequality",
    """WITH cells AS (
         SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period, l_suppkey%10+1 AS band, l_returnflag AS flag,
                CAST(l_quantity AS INT) AS q FROM lineitem),
       m AS (SELECT period, 'imd_decile' AS stratifier, CAST(band AS VARCHAR) AS stratum, count(*) AS population_count, median(q) AS metric_value
             FROM cells GROUP BY ALL
             UNION ALL SELECT period, 'flag', flag, count(*), median(q) FROM cells GROUP BY ALL)
       SELECT period, stratifier, stratum, population_count, metric_value FROM m""",
)
def d14_quantity(r: Roles) -> DataFrame:
    """The median operator on the largest table, without the star schema before it."""
    cells = r.raw("lineitem").select(
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month"),
        (F.col("l_suppkey") % 10 + 1).alias("imd_decile"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_quantity").cast("int").alias("q"),
    )
    one = stratified_median(cells, "quantity", "month", "q", ["imd_decile", "flag"])
    return union_metrics([one]).drop("metric_name")
