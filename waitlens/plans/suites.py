"""The declared data tests of every conformed and star-schema table."""

from __future__ import annotations

from waitlens.contracts import GOLD_AGE_BANDS
from waitlens.operators.quality import Check, accepted_values, between, not_null, row_count, unique

# Vocabularies and limits of the declared tests.
SILVER_AGE_BANDS = ("0-15", "16-24", "25-34", "35-44", "45-54", "55-64", "65-74", "75+")
STRATIFIER_NAMES = ("imd_decile", "age_band", "ethnicity_ons", "sex")
DECILES = (1, 10)
LONGEST_WAIT_DAYS = 1825
BOTH = (True, False)


def key(column: str) -> list[Check]:
    """A column that names its row."""
    return [not_null(column), unique(column)]


def flag(column: str, required: bool = True) -> list[Check]:
    return [not_null(column)] * required + [accepted_values(column, BOTH)]


def linked(column: str) -> list[Check]:
    """Rows of a table whose patient may be quarantined: the key matters, the link warns."""
    return [*key(column), not_null("patient_sk", severity="warn")]


SILVER_SUITES: dict[str, list[Check]] = {
    "patients": [
        row_count(1),
        *key("patient_sk"),
        not_null("_ingest_date"),
        accepted_values("age_band", SILVER_AGE_BANDS, severity="warn"),
        not_null("ethnicity_ons", severity="warn"),
        between("imd_decile", *DECILES),
    ],
    "patient_identifiers": [*key("patient_id"), not_null("patient_sk")],
    "patients_quarantine": [not_null("patient_id"), not_null("rejection_reason")],
    "encounters": [row_count(1), *linked("encounter_id")],
    "referrals": [row_count(1), *linked("referral_id")],
    "diagnoses": linked("diagnosis_id"),
    "diagnostics_orders": linked("diagnostic_id"),
    "appointments": [row_count(1), *linked("appointment_id")],
    "urgent_care": [row_count(1), *linked("uc_log_id")],
    "providers": [row_count(1), *key("provider_code"), not_null("provider_id")],
}
GOLD_SUITES: dict[str, list[Check]] = {
    "dim_patient": [
        *key("patient_sk"),
        *flag("is_current"),
        not_null("valid_from"),
        accepted_values("age_band", GOLD_AGE_BANDS),
        between("imd_decile", *DECILES),
    ],
    "dim_date": [row_count(3650, 4100), *key("date_sk"), *key("calendar_date")],
    "dim_specialty": [*key("specialty_sk"), *key("specialty_code")],
    "dim_site": [*key("site_sk"), *key("provider_code"), not_null("provider_id")],
    "dim_imd": [row_count(10, 10), *key("imd_sk"), *key("imd_decile")],
    "dim_ethnicity": [row_count(17, 20), *key("ethnicity_sk"), *key("ethnicity_code")],
    "fct_wait_times": [
        row_count(1),
        *key("referral_id"),
        not_null("patient_sk", where="patient_sk IS NOT NULL", severity="warn"),
        not_null("referral_date"),
        between("wait_days", 0, LONGEST_WAIT_DAYS, where="wait_days IS NOT NULL"),
        *flag("rtt_breach_flag", required=False),
    ],
    "fct_inequality": [
        row_count(1),
        unique("metric_name", "period", "stratifier", "stratum"),
        not_null("metric_name"),
        not_null("stratifier"),
        accepted_values("stratifier", STRATIFIER_NAMES),
        not_null("stratum"),
    ],
    "fct_urgent_care": [
        row_count(1),
        *linked("uc_log_id"),
        *flag("four_hour_breach_flag"),
        *flag("twelve_hour_breach_flag"),
    ],
    "fct_utilisation": [
        row_count(1),
        *linked("appointment_id"),
        *flag("dna_flag"),
        not_null("appointment_month"),
    ],
}
