"""Entity registry and table contracts shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DateType, StringType, StructType


@dataclass(frozen=True)
class Entity:
    """One Bronze entity: where it lands, its key, its schema."""

    name: str
    source: str
    pk: str
    pk_type: str
    join_keys: tuple[str, ...]
    ddl: str
    business_date: str | None = None
    text_timestamps: tuple[str, ...] = field(default=())

    @property
    def path(self) -> str:
        return f"source={self.source}/entity={self.name}"

    def schema(self, with_partition: bool = True) -> StructType:
        parsed = _struct(self.ddl)
        return parsed.add("ingest_date", DateType()) if with_partition else parsed


def _struct(ddl: str) -> StructType:
    """Parse a plain ``name type, ...`` list without needing a running session."""
    simple = {
        "BIGINT": "long",
        "INT": "integer",
        "STRING": "string",
        "DATE": "date",
        "TIMESTAMP": "timestamp_ntz",
        "BOOLEAN": "boolean",
    }
    fields = []
    for item in ddl.split(","):
        name, kind = item.split()
        fields.append({"name": name, "type": simple[kind], "nullable": True, "metadata": {}})
    return StructType.fromJson({"type": "struct", "fields": fields})


# Entity names, sources, keys, business dates and columns of the Bronze layer.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "patient_demographics",
            "ehr_postgres",
            "patient_id",
            "bigint",
            ("patient_id",),
            "patient_id BIGINT, nhs_pseudo_id STRING, date_of_birth DATE, age BIGINT, "
            "age_band STRING, sex STRING, ethnicity_ons STRING, imd_decile BIGINT, "
            "chronic_conditions_count BIGINT, lsoa_code STRING, postcode_sector STRING, "
            "registered_gp_practice_id STRING, registration_start_date DATE, "
            "registration_end_date DATE, is_active BOOLEAN, updated_at TIMESTAMP",
            business_date="registration_start_date",
        ),
        Entity(
            "encounters",
            "ehr_postgres",
            "encounter_id",
            "bigint",
            ("patient_id", "provider_id", "clinician_id"),
            "encounter_id BIGINT, patient_id BIGINT, provider_id BIGINT, "
            "encounter_datetime_start TIMESTAMP, encounter_datetime_end TIMESTAMP, "
            "encounter_type STRING, source_system STRING, clinician_id BIGINT, priority STRING, "
            "was_attended BOOLEAN, first_attendance_flag BOOLEAN, primary_condition_code STRING, "
            "wait_time_days BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP",
            business_date="encounter_datetime_start",
        ),
        Entity(
            "referrals",
            "ehr_postgres",
            "referral_id",
            "bigint",
            ("patient_id", "source_provider_id", "target_provider_id"),
            "referral_id BIGINT, patient_id BIGINT, source_provider_id BIGINT, "
            "target_provider_id BIGINT, referral_datetime TIMESTAMP, referral_type STRING, "
            "referral_specialty STRING, status STRING, created_at TIMESTAMP, updated_at TIMESTAMP",
            business_date="referral_datetime",
        ),
        Entity(
            "diagnoses",
            "ehr_postgres",
            "diagnosis_id",
            "bigint",
            ("patient_id", "encounter_id"),
            "diagnosis_id BIGINT, patient_id BIGINT, encounter_id BIGINT, diagnosis_code STRING, "
            "diagnosis_desc STRING, diagnosis_type STRING, coded_datetime TIMESTAMP, "
            "clinical_datetime TIMESTAMP, source_system STRING, created_at TIMESTAMP, "
            "updated_at TIMESTAMP",
            business_date="clinical_datetime",
        ),
        Entity(
            "appointments",
            "sftp_appointments",
            "appointment_id",
            "varchar",
            ("patient_id", "nhs_pseudo_id"),
            "appointment_id STRING, patient_id STRING, nhs_pseudo_id STRING, "
            "registered_gp_practice_id STRING, service_location_id STRING, clinician_id STRING, "
            "appointment_start_datetime STRING, appointment_end_datetime STRING, "
            "appointment_type STRING, mode STRING, slot_type STRING, booking_status STRING, "
            "booking_created_datetime STRING, booking_updated_datetime STRING, "
            "wait_time_days STRING, imd_decile STRING",
            text_timestamps=(
                "appointment_start_datetime",
                "appointment_end_datetime",
                "booking_created_datetime",
                "booking_updated_datetime",
            ),
        ),
        Entity(
            "urgent_care_logs",
            "urgent_care_postgres",
            "uc_log_id",
            "bigint",
            ("patient_id", "provider_id", "encounter_id"),
            "uc_log_id BIGINT, patient_id BIGINT, provider_id BIGINT, encounter_id BIGINT, "
            "arrival_datetime TIMESTAMP, triage_datetime TIMESTAMP, "
            "seen_by_clinician_datetime TIMESTAMP, departure_datetime TIMESTAMP, "
            "triage_category STRING, presenting_complaint STRING, outcome STRING, "
            "source_system STRING, created_at TIMESTAMP, updated_at TIMESTAMP",
            business_date="arrival_datetime",
        ),
        Entity(
            "diagnostics_orders",
            "trust_s3_diagnostics",
            "diagnostic_id",
            "varchar",
            ("patient_id", "referral_id", "encounter_id", "provider_id"),
            "diagnostic_id STRING, patient_id STRING, referral_id STRING, encounter_id STRING, "
            "provider_id STRING, test_type STRING, test_panel STRING, request_date STRING, "
            "performed_date STRING, result_date STRING, result_flag STRING",
            text_timestamps=("request_date", "performed_date", "result_date"),
        ),
        Entity(
            "provider_site_reference",
            "trust_s3_provider_ref",
            "provider_id",
            "bigint",
            ("provider_id", "provider_code"),
            "provider_id STRING, provider_code STRING, site_name STRING, provider_type STRING, "
            "parent_trust_name STRING, ics_region STRING, address_line_1 STRING, city STRING, "
            "postcode STRING, postcode_sector STRING, lsoa_code STRING, is_main_site STRING, "
            "site_status STRING, has_ed STRING, has_inpatient_beds STRING, size_band STRING, "
            "opening_hours STRING, service_lines STRING, site_manager_name STRING, "
            "site_manager_email STRING",
        ),
    )
}

# Which entities must carry which join key.
JOIN_KEY_HOLDERS: dict[str, tuple[str, ...]] = {
    "patient_id": (
        "patient_demographics",
        "encounters",
        "referrals",
        "diagnoses",
        "appointments",
        "urgent_care_logs",
        "diagnostics_orders",
    ),
    "provider_id": (
        "encounters",
        "urgent_care_logs",
        "diagnostics_orders",
        "provider_site_reference",
    ),
    "encounter_id": ("encounters", "diagnoses", "urgent_care_logs", "diagnostics_orders"),
}

# Child entity, child column, parent entity, parent column.
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("encounters", "patient_id", "patient_demographics", "patient_id"),
    ("referrals", "patient_id", "patient_demographics", "patient_id"),
    ("diagnoses", "patient_id", "patient_demographics", "patient_id"),
    ("diagnoses", "encounter_id", "encounters", "encounter_id"),
    ("urgent_care_logs", "patient_id", "patient_demographics", "patient_id"),
    ("encounters", "provider_id", "provider_site_reference", "provider_id"),
    ("urgent_care_logs", "provider_id", "provider_site_reference", "provider_id"),
)

# Entities whose identifiers are known to arrive as text.
TEXT_KEY_ENTITIES = ("appointments", "diagnostics_orders")

# Tables of the star schema that are exported.
GOLD_TABLES = (
    "dim_date",
    "dim_ethnicity",
    "dim_imd",
    "dim_patient",
    "dim_site",
    "dim_specialty",
    "fct_inequality",
    "fct_urgent_care",
    "fct_utilisation",
    "fct_wait_times",
)

# Vocabularies the data tests check.
SEX_CODES = ("M", "F", "I", "U")
SILVER_AGE_BANDS = ("0-15", "16-24", "25-34", "35-44", "45-54", "55-64", "65-74", "75+")
GOLD_AGE_BANDS = ("0-15", "16-24", "25-44", "45-64", "65-79", "80+")
STRATIFIERS = ("imd_decile", "age_band", "ethnicity_ons", "sex")
STRATIFIER_LABELS = {
    "IMD Decile": "imd_decile",
    "Ethnicity": "ethnicity_ons",
    "Age Band": "age_band",
    "Sex": "sex",
}

# Limits of the access standards, in days or minutes.
RTT_BREACH_DAYS = 126
DM01_BREACH_DAYS = 42
LONG_WAIT_DAYS = 364
FOUR_HOURS_MINUTES = 240
TWELVE_HOURS_MINUTES = 720
SMALL_CELL = 5

def declared_types(entity: Entity) -> dict[str, str]:
    """Kinds of an entity's columns that are not text, as ``lake.coerce`` takes them."""
    kinds = {"bigint": "int64", "date": "date", "timestamp_ntz": "timestamp", "boolean": "bool"}
    return {
        f.name: kinds[f.dataType.simpleString()]
        for f in entity.schema(with_partition=False)
        if not isinstance(f.dataType, StringType)
    }


# Column types the historical load coerces to: the declared types of the loaded entities.
BACKFILL_TYPES: dict[str, dict[str, str]] = {
    name: declared_types(ENTITIES[name])
    for name in (
        "patient_demographics",
        "encounters",
        "referrals",
        "diagnoses",
        "urgent_care_logs",
    )
}
BACKFILL_TYPES["patient_demographics"]["nhs_pseudo_id"] = "str"
