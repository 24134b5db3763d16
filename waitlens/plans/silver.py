"""Conformed (Silver) models.

Each model takes the new Bronze rows and returns the batch to upsert. ``MODELS`` names
the Bronze source, the merge key and the sort order of each stored table. The column
lists are contracts: contact details, raw identifiers and stale attributes end here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.contracts import SEX_CODES
from waitlens.functions.identifiers import digits_to_bigint, hmac_sha256, in_domain, mod11_reason
from waitlens.functions.temporal import to_utc
from waitlens.operators.conform import (
    dedup_latest,
    latest_rejected,
    latest_valid,
    lookup,
    resolve_key,
    with_audit,
)
from waitlens.sources.keyed import Bucket, digits_bucket, hash_bucket, range_bucket


@dataclass(frozen=True)
class Context:
    """What a model needs besides its rows: the key, and the load time to stamp."""

    key: bytes
    as_of: Column | None = None
    #: Why a patient without a number is quarantined. None counts the number as valid, as
    #: published; such a patient has no surrogate, and an upsert by surrogate refuses it.
    missing_reason: str | None = "missing"

    def __repr__(self) -> str:
        return "Context(key=<hidden>)"


_PATIENT_ORDER = (["patient_id"], ["updated_at"], ["ingest_date", "nhs_pseudo_id", "lsoa_code"])


def classify_patients(bronze: DataFrame, ctx: Context) -> DataFrame:
    """Bronze patients with the reason their number is unusable, if any."""
    return bronze.withColumn("_reason", mod11_reason(F.col("nhs_pseudo_id"), ctx.missing_reason))


def patients(bronze: DataFrame, areas: DataFrame, ctx: Context) -> DataFrame:
    """Valid patients, pseudonymised, with the deprivation decile of their area."""
    valid = latest_valid(classify_patients(bronze, ctx), "_reason", *_PATIENT_ORDER)
    placed = lookup(valid.drop("imd_decile"), areas, "lsoa_code")
    return with_audit(placed, ctx.as_of).select(
        hmac_sha256(F.col("nhs_pseudo_id"), ctx.key).alias("patient_sk"),
        "age_band",
        in_domain(F.col("sex"), SEX_CODES, "U").alias("sex"),
        "ethnicity_ons",
        "imd_decile",
        "imd_label",
        "deprivation_level",
        F.col("chronic_conditions_count").cast("int").alias("chronic_conditions_count"),
        "registered_gp_practice_id",
        F.col("registration_start_date").cast("date").alias("registration_start_date"),
        F.col("registration_end_date").cast("date").alias("registration_end_date"),
        "is_active",
        "_ingest_date",
        "_loaded_at",
    )


def patient_identifiers(bronze: DataFrame, ctx: Context) -> DataFrame:
    """The restricted vault: surrogate to source id, and what could re-identify."""
    valid = latest_valid(classify_patients(bronze, ctx), "_reason", *_PATIENT_ORDER)
    return with_audit(valid, ctx.as_of).select(
        hmac_sha256(F.col("nhs_pseudo_id"), ctx.key).alias("patient_sk"),
        F.col("patient_id").cast("bigint").alias("patient_id"),
        F.col("date_of_birth").cast("date").alias("date_of_birth"),
        "postcode_sector",
        "lsoa_code",
        "_ingest_date",
        "_loaded_at",
    )


def patients_quarantine(bronze: DataFrame, ctx: Context) -> DataFrame:
    """Patients whose latest row has an unusable number, and why."""
    rejected = latest_rejected(classify_patients(bronze, ctx), "_reason", *_PATIENT_ORDER)
    return with_audit(rejected, ctx.as_of).select(
        F.col("patient_id").cast("bigint").alias("patient_id"),
        "nhs_pseudo_id",
        "age_band",
        "sex",
        "ethnicity_ons",
        F.col("date_of_birth").cast("date").alias("date_of_birth"),
        "postcode_sector",
        "lsoa_code",
        F.col("chronic_conditions_count").cast("int").alias("chronic_conditions_count"),
        "registered_gp_practice_id",
        F.col("registration_start_date").cast("date").alias("registration_start_date"),
        F.col("registration_end_date").cast("date").alias("registration_end_date"),
        "is_active",
        F.col("_reason").alias("rejection_reason"),
        F.col("_loaded_at").alias("rejected_at"),
        "_ingest_date",
        "_loaded_at",
    )


def _utc(*columns: str) -> list[Column]:
    return [to_utc(F.col(c)).alias(c) for c in columns]


def encounters(bronze: DataFrame, vault: DataFrame, ctx: Context) -> DataFrame:
    latest = dedup_latest(
        bronze,
        ["encounter_id"],
        ["updated_at"],
        ["ingest_date", "clinician_id", "provider_id", "encounter_datetime_start", "wait_time_days"],
    )
    keyed = resolve_key(latest, vault, F.col("patient_id"), ["encounter_id"])
    return with_audit(keyed, ctx.as_of).select(
        "encounter_id",
        "patient_sk",
        "provider_id",
        *_utc("encounter_datetime_start", "encounter_datetime_end"),
        "encounter_type",
        "source_system",
        "clinician_id",
        "priority",
        "was_attended",
        "first_attendance_flag",
        "primary_condition_code",
        F.col("wait_time_days").cast("int").alias("wait_time_days"),
        *_utc("created_at"),
        "_ingest_date",
        "_loaded_at",
    )


def referrals(
    bronze: DataFrame, vault: DataFrame, ctx: Context, beside: DataFrame | None = None
) -> DataFrame:
    """One row per referral.

    ``beside`` has at most one row per ``referral_id``; its columns end the row. It is joined
    before the patient is resolved, while the referrals still lie by their id.
    """
    latest = dedup_latest(
        bronze, ["referral_id"], ["updated_at"], ["ingest_date", "referral_datetime", "status"]
    )
    more = []
    if beside is not None:
        latest = latest.join(beside, "referral_id", "left")
        more = [c for c in beside.columns if c != "referral_id"]
    keyed = resolve_key(latest, vault, F.col("patient_id"), ["referral_id"])
    return with_audit(keyed, ctx.as_of).select(
        "referral_id",
        "patient_sk",
        "source_provider_id",
        "target_provider_id",
        *_utc("referral_datetime"),
        "referral_type",
        "referral_specialty",
        "status",
        *_utc("created_at"),
        "_ingest_date",
        "_loaded_at",
        *more,
    )


def diagnoses(bronze: DataFrame, vault: DataFrame, ctx: Context) -> DataFrame:
    """Coded diagnoses; an empty source yields an empty table."""
    latest = dedup_latest(
        bronze, ["diagnosis_id"], ["updated_at"], ["ingest_date", "coded_datetime", "diagnosis_code"]
    )
    keyed = resolve_key(latest, vault, F.col("patient_id"), ["diagnosis_id"])
    return with_audit(keyed, ctx.as_of).select(
        "diagnosis_id",
        "patient_sk",
        "encounter_id",
        "diagnosis_code",
        "diagnosis_desc",
        "diagnosis_type",
        *_utc("coded_datetime", "clinical_datetime"),
        "source_system",
        *_utc("created_at"),
        "_ingest_date",
        "_loaded_at",
    )


def diagnostics_orders(
    bronze: DataFrame, vault: DataFrame, ctx: Context, dedup_conformed: bool = False
) -> DataFrame:
    """Diagnostic orders, ids reduced to their digits.

    The delivered id is what is deduplicated, so ids differing only in letters both stay
    and then share a merge key, which the store refuses. ``dedup_conformed`` keeps one of
    them instead.
    """
    order = (
        ["request_date"],
        ["ingest_date", "result_date", "performed_date", "patient_id", "provider_id", "test_type"],
    )
    latest = dedup_latest(bronze, ["diagnostic_id"], *order)
    if dedup_conformed:
        latest = dedup_latest(
            latest.withColumn("_id", digits_to_bigint(F.col("diagnostic_id"))),
            ["_id"],
            order[0],
            [*order[1], "diagnostic_id"],
        ).drop("_id")
    # Parsed before the join: it carries numbers and days in place of text, and a reader that
    # needs no surrogate does without it.
    days = [F.col(c).cast("date").alias(c) for c in ("request_date", "performed_date", "result_date")]
    numbers = [
        digits_to_bigint(F.col(c)).alias(c)
        for c in ("diagnostic_id", "patient_id", "referral_id", "encounter_id", "provider_id")
    ]
    parsed = latest.select(
        F.col("diagnostic_id").alias("_delivered_id"), *numbers, "test_type", "test_panel", *days,
        "result_flag", "ingest_date",
    )
    keyed = resolve_key(parsed, vault, F.col("patient_id"), ["_delivered_id"])
    return with_audit(keyed, ctx.as_of).select(
        "diagnostic_id",
        "patient_sk",
        "referral_id",
        "encounter_id",
        "provider_id",
        "test_type",
        "test_panel",
        "request_date",
        "performed_date",
        "result_date",
        "result_flag",
        "_ingest_date",
        "_loaded_at",
    )


def appointments(bronze: DataFrame, vault: DataFrame, ctx: Context) -> DataFrame:
    """Booked appointments; every date and number arrives as text and must parse."""
    latest = dedup_latest(
        bronze,
        ["appointment_id"],
        ["booking_updated_datetime"],
        ["ingest_date", "booking_created_datetime", "appointment_start_datetime", "booking_status"],
    )
    keyed = resolve_key(
        latest, vault, F.col("patient_id").cast("bigint"), ["appointment_id"]
    )

    def parsed(*columns: str) -> list[Column]:
        return [to_utc(F.col(c).cast("timestamp_ntz")).alias(c) for c in columns]

    return with_audit(keyed, ctx.as_of).select(
        "appointment_id",
        "patient_sk",
        "registered_gp_practice_id",
        "service_location_id",
        "clinician_id",
        *parsed("appointment_start_datetime", "appointment_end_datetime"),
        "appointment_type",
        "mode",
        "slot_type",
        "booking_status",
        *parsed("booking_created_datetime", "booking_updated_datetime"),
        F.col("wait_time_days").cast("int").alias("wait_time_days"),
        "_ingest_date",
        "_loaded_at",
    )


def urgent_care(bronze: DataFrame, vault: DataFrame, ctx: Context) -> DataFrame:
    latest = dedup_latest(
        bronze,
        ["uc_log_id"],
        ["updated_at"],
        ["ingest_date", "arrival_datetime", "departure_datetime", "outcome"],
    )
    keyed = resolve_key(latest, vault, F.col("patient_id"), ["uc_log_id"])
    return with_audit(keyed, ctx.as_of).select(
        "uc_log_id",
        "patient_sk",
        "provider_id",
        "encounter_id",
        *_utc(
            "arrival_datetime", "triage_datetime", "seen_by_clinician_datetime", "departure_datetime"
        ),
        "triage_category",
        "presenting_complaint",
        "outcome",
        "source_system",
        *_utc("created_at"),
        "_ingest_date",
        "_loaded_at",
    )


def providers(bronze: DataFrame, ctx: Context) -> DataFrame:
    """Provider sites without their managers' contact details."""
    latest = dedup_latest(
        bronze, ["provider_code"], ["ingest_date"], ["provider_id", "site_name", "site_status"]
    )
    return with_audit(latest, ctx.as_of).select(
        F.col("provider_id").cast("bigint").alias("provider_id"),
        "provider_code",
        "site_name",
        "provider_type",
        "parent_trust_name",
        "ics_region",
        "address_line_1",
        "city",
        "postcode",
        "postcode_sector",
        "lsoa_code",
        "is_main_site",
        "site_status",
        "has_ed",
        "has_inpatient_beds",
        "size_band",
        "opening_hours",
        "service_lines",
        "_ingest_date",
        "_loaded_at",
    )


@dataclass(frozen=True)
class Model:
    """How a conformed table is built and stored."""

    source: str
    build: Callable
    needs: str
    merge_key: str
    database: str
    sort_by: tuple[str, ...] = ()

    @property
    def bucket(self) -> Bucket:
        """Row ids are handed out in order, also behind a letter; surrogates and codes are not."""
        if self.merge_key == "appointment_id":
            return digits_bucket(self.merge_key)
        ordered = self.merge_key.endswith("_id")
        return range_bucket(self.merge_key) if ordered else hash_bucket(self.merge_key)


# In build order: the vault comes before everything that resolves keys.
MODELS: dict[str, Model] = {
    "patients": Model(
        "patient_demographics", patients, "areas", "patient_sk", "silver", ("registration_start_date",)
    ),
    "patient_identifiers": Model(
        "patient_demographics", patient_identifiers, "", "patient_id", "silver_keys", ("patient_id",)
    ),
    "patients_quarantine": Model(
        "patient_demographics", patients_quarantine, "", "patient_id", "silver_quarantine"
    ),
    "encounters": Model(
        "encounters", encounters, "vault", "encounter_id", "silver", ("encounter_datetime_start",)
    ),
    "referrals": Model(
        "referrals", referrals, "vault", "referral_id", "silver", ("referral_datetime",)
    ),
    "diagnoses": Model("diagnoses", diagnoses, "vault", "diagnosis_id", "silver", ("coded_datetime",)),
    "diagnostics_orders": Model(
        "diagnostics_orders", diagnostics_orders, "vault", "diagnostic_id", "silver", ("request_date",)
    ),
    "appointments": Model(
        "appointments", appointments, "vault", "appointment_id", "silver",
        ("appointment_start_datetime",),
    ),
    "urgent_care": Model(
        "urgent_care_logs", urgent_care, "vault", "uc_log_id", "silver", ("arrival_datetime",)
    ),
    "providers": Model(
        "provider_site_reference", providers, "", "provider_code", "silver", ("provider_code",)
    ),
}
