"""Star schema (Gold): six dimensions and four facts, rebuilt from Silver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.contracts import (
    DM01_BREACH_DAYS,
    FOUR_HOURS_MINUTES,
    RTT_BREACH_DAYS,
    SMALL_CELL,
    STRATIFIERS,
    TWELVE_HOURS_MINUTES,
)
from waitlens.functions.identifiers import packed, unpacked
from waitlens.functions.temporal import days_between, minutes_crossed, month_start, over_threshold
from waitlens.operators.conform import left_join_on, require_unique
from waitlens.operators.dims import calendar, dense_key, validity
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
from waitlens.session import settle
from waitlens.sources.seeds import load_seed


def dim_date(spark: SparkSession) -> DataFrame:
    return calendar(spark)


def dim_patient(patients: DataFrame) -> DataFrame:
    return validity(patients, "registration_start_date", "registration_end_date").select(
        "patient_sk",
        "age_band",
        "sex",
        "ethnicity_ons",
        "imd_decile",
        "imd_label",
        "deprivation_level",
        "chronic_conditions_count",
        "registered_gp_practice_id",
        "valid_from",
        "valid_to",
        "is_current",
    )


def dim_site(providers: DataFrame) -> DataFrame:
    """Active sites, however the status is spelled."""
    active = providers.where(F.upper("site_status") == "ACTIVE").select(
        "provider_id",
        "provider_code",
        "site_name",
        F.col("site_name").alias("provider_name"),
        "provider_type",
        "ics_region",
        "has_ed",
        "has_inpatient_beds",
        "size_band",
    )
    return dense_key(active, ["provider_code"], "site_sk")


def dim_specialty(referrals: DataFrame) -> DataFrame:
    codes = (
        referrals.where(F.col("referral_specialty").isNotNull())
        .select(F.col("referral_specialty").alias("specialty_code"))
        .distinct()
        .withColumn("specialty_name", F.col("specialty_code"))
    )
    return dense_key(codes, ["specialty_code"], "specialty_sk")


def dim_imd(spark: SparkSession) -> DataFrame:
    return dense_key(load_seed(spark, "imd"), ["imd_decile"], "imd_sk")


def dim_ethnicity(spark: SparkSession) -> DataFrame:
    return dense_key(load_seed(spark, "ethnicity"), ["ethnicity_code"], "ethnicity_sk")


def _with_treatment(requests: DataFrame, encounters: DataFrame) -> DataFrame:
    """Referrals with the date, wait, breach and month of their first treatment.

    The wait is the one reported on the matched encounter.
    """
    attended = encounters.where("was_attended").select(
        "patient_sk", "encounter_datetime_start", "wait_time_days"
    )
    treated = first_match(
        requests, attended, "patient_sk", "referral_date", "encounter_datetime_start", "wait_time_days"
    )
    treatment = F.col("matched_at").cast("date")
    wait = F.coalesce(F.col("matched_gap"), days_between(F.col("referral_date"), treatment))
    return treated.select(
        *requests.columns,
        treatment.alias("treatment_date"),
        wait.alias("wait_days"),
        over_threshold(wait, RTT_BREACH_DAYS).alias("rtt_breach_flag"),
        month_start(treatment).alias("treatment_month"),
    )


def waits_to_treatment(referrals: DataFrame, encounters: DataFrame) -> DataFrame:
    """What ``inequality_base`` reads of the wait fact, without its tests, sites and specialties."""
    requests = referrals.select("patient_sk", F.col("referral_datetime").cast("date").alias("referral_date"))
    return _with_treatment(requests, encounters).select("patient_sk", "treatment_month", "wait_days")


def stays(urgent_care: DataFrame) -> DataFrame:
    """What ``inequality_base`` reads of the urgent-care fact, without its sites."""
    return urgent_care.select(
        "patient_sk",
        month_start(F.col("arrival_datetime")).alias("arrival_month"),
        over_threshold(
            minutes_crossed(F.col("arrival_datetime"), F.col("departure_datetime")), FOUR_HOURS_MINUTES
        ).alias("four_hour_breach_flag"),
    )


_FIRST_TESTS = {"dm01_request_date": "request_date", "dm01_result_date": "result_date"}


def first_tests(diagnostics: DataFrame) -> DataFrame:
    """First request and first result per referral."""
    return milestones(diagnostics, "referral_id", "request_date", _FIRST_TESTS)


def fct_wait_times(
    referrals: DataFrame,
    encounters: DataFrame,
    diagnostics: DataFrame | None,
    specialties: DataFrame,
    sites: DataFrame,
) -> DataFrame:
    """One row per referral: time to treatment and to diagnostic result.

    Without ``diagnostics`` the referrals bring the columns of ``first_tests`` along.
    """
    # The surrogate is most of a row's bytes, so it travels packed.
    surrogate = packed(F.col("patient_sk")).alias("patient_sk")
    base = referrals.select(
        "referral_id",
        surrogate,
        "target_provider_id",
        "referral_datetime",
        F.col("referral_datetime").cast("date").alias("referral_date"),
        "referral_specialty",
        "status",
        *(_FIRST_TESTS if diagnostics is None else ()),
    )
    # By referral first, while the referrals still lie as they were read; a patient's rows then
    # end together, which also makes the written fact smaller.
    tested = base if diagnostics is None else base.join(first_tests(diagnostics), "referral_id", "left")
    treated = _with_treatment(tested, encounters.withColumn("patient_sk", surrogate))
    placed = left_join_on(
        treated,
        sites.select("provider_id", "site_sk"),
        F.col("target_provider_id"),
        "provider_id",
        ["referral_id"],
    )
    timed = left_join_on(
        placed,
        specialties.select("specialty_code", "specialty_sk"),
        F.col("referral_specialty"),
        "specialty_code",
        ["referral_id"],
    )
    return interval_breach(
        timed,
        "dm01_request_date",
        "dm01_result_date",
        DM01_BREACH_DAYS,
        "dm01_wait_days",
        "dm01_breach_flag",
    ).select(
        "referral_id",
        unpacked(F.col("patient_sk")).alias("patient_sk"),
        "specialty_sk",
        "site_sk",
        "referral_datetime",
        "referral_date",
        "treatment_date",
        "wait_days",
        "rtt_breach_flag",
        "dm01_request_date",
        "dm01_result_date",
        "dm01_wait_days",
        "dm01_breach_flag",
        "treatment_month",
        "referral_specialty",
        "status",
    )


def fct_urgent_care(urgent_care: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per attendance: stage times, breach flags, admission."""
    staged = stage_minutes(
        urgent_care,
        "arrival_datetime",
        {
            "arrival_to_triage_mins": "triage_datetime",
            "arrival_to_seen_mins": "seen_by_clinician_datetime",
            "arrival_to_discharge_mins": "departure_datetime",
        },
    )
    placed = left_join_on(
        staged,
        sites.select("provider_id", "site_sk"),
        F.col("provider_id"),
        "provider_id",
        ["uc_log_id"],
    )
    stay = F.col("arrival_to_discharge_mins")
    return placed.select(
        "uc_log_id",
        "patient_sk",
        "provider_id",
        "site_sk",
        "arrival_datetime",
        "triage_datetime",
        "seen_by_clinician_datetime",
        "departure_datetime",
        "arrival_to_triage_mins",
        "arrival_to_seen_mins",
        "arrival_to_discharge_mins",
        over_threshold(stay, FOUR_HOURS_MINUTES).alias("four_hour_breach_flag"),
        over_threshold(stay, TWELVE_HOURS_MINUTES).alias("twelve_hour_breach_flag"),
        status_flag(F.col("outcome"), "admitted", "admission", ignore_case=True).alias("admitted_flag"),
        "triage_category",
        "presenting_complaint",
        "outcome",
        month_start(F.col("arrival_datetime")).alias("arrival_month"),
    )


def fct_utilisation(appointments: DataFrame, patients: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per appointment: outcome flags, site, demographics of current patients.

    ``patients`` is ``dim_patient``.
    """
    current = patients.where("is_current").select(
        F.col("patient_sk").alias("_current_sk"), "imd_decile", "age_band", "sex", "ethnicity_ons"
    )
    known = left_join_on(
        appointments, current, F.col("patient_sk"), "_current_sk", ["appointment_id"]
    )
    placed = left_join_on(
        known,
        sites.select("provider_code", "site_sk"),
        F.col("service_location_id").cast("string"),
        "provider_code",
        ["appointment_id"],
    )
    status = F.col("booking_status")
    return placed.select(
        "appointment_id",
        "patient_sk",
        "site_sk",
        "appointment_start_datetime",
        "appointment_end_datetime",
        "appointment_type",
        "mode",
        "slot_type",
        "booking_status",
        status_flag(status, "DNA").alias("dna_flag"),
        status_flag(status, "attended").alias("attended_flag"),
        contains_flag(status, "cancel").alias("cancelled_flag"),
        "wait_time_days",
        "imd_decile",
        "age_band",
        "sex",
        "ethnicity_ons",
        month_start(F.col("appointment_start_datetime")).alias("appointment_month"),
    )


def strata(dim_patient: DataFrame) -> DataFrame:
    """Current patients and the attributes metrics are split by."""
    return dim_patient.where("is_current").select(
        "patient_sk",
        "imd_decile",
        "age_band",
        F.coalesce("ethnicity_ons", F.lit("Unknown")).alias("ethnicity_ons"),
        "sex",
    )


def inequality_base(
    waits: DataFrame, attendances: DataFrame, appointments: DataFrame, dim_patient: DataFrame
) -> DataFrame:
    """Three metrics by month, stratifier and stratum; each fact is scanned once."""
    who = strata(dim_patient)
    wait_events = waits.where("wait_days IS NOT NULL").select("patient_sk", "treatment_month", "wait_days")
    stays = attendances.select("patient_sk", "arrival_month", "four_hour_breach_flag")
    booked = appointments.select(
        "patient_sk",
        month_start(F.col("appointment_start_datetime")).alias("_month"),
        "booking_status",
    )
    missed = status_flag(F.col("booking_status"), "DNA")
    return union_metrics(
        [
            stratified_median(
                wait_events.join(who, "patient_sk"),
                "wait_time_median", "treatment_month", "wait_days", STRATIFIERS,
            ),
            stratified_rate(
                stays.join(who, "patient_sk"),
                "four_hour_breach_rate", "arrival_month", F.col("four_hour_breach_flag"), STRATIFIERS,
            ),
            stratified_rate(
                booked.join(who, "patient_sk"), "dna_rate", "_month", missed, STRATIFIERS
            ),
        ]
    )


def fct_inequality(
    waits: DataFrame,
    attendances: DataFrame,
    appointments: DataFrame,
    dim_patient: DataFrame,
    method: str = "reference",
    also_suppress: tuple[str, ...] = (),
) -> DataFrame:
    """Long-form inequality table.

    Small cells lose count and value. Their ridit score still shows the size, as in the
    published layout; name more columns in ``also_suppress`` to hide it.
    """
    base = inequality_base(waits, attendances, appointments, dim_patient)
    indexed = with_slope_indices(with_ridit(base), method).drop("weight")
    return suppress_small(
        indexed, ["population_count", "metric_value", *also_suppress], below=SMALL_CELL
    )


def build_gold(spark: SparkSession, silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All ten tables from the conformed ones."""
    sites = dim_site(silver["providers"])
    # Facts look sites up by provider id, while sites are unique by code.
    require_unique(sites, ["provider_id"])
    specialties = dim_specialty(silver["referrals"])
    people = dim_patient(silver["patients"])
    # These two facts are exported and feed the inequality table: compute them once.
    waits = settle(
        fct_wait_times(
            silver["referrals"], silver["encounters"], silver["diagnostics_orders"], specialties, sites
        )
    )
    attendances = settle(fct_urgent_care(silver["urgent_care"], sites))
    return {
        "dim_date": dim_date(spark),
        "dim_ethnicity": dim_ethnicity(spark),
        "dim_imd": dim_imd(spark),
        "dim_patient": people,
        "dim_site": sites,
        "dim_specialty": specialties,
        "fct_wait_times": waits,
        "fct_urgent_care": attendances,
        "fct_utilisation": fct_utilisation(silver["appointments"], people, sites),
        "fct_inequality": fct_inequality(waits, attendances, silver["appointments"], people),
    }
