"""Conforming operators, Silver models and dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.contracts import SEX_CODES
from waitlens.functions.identifiers import digits_to_bigint, hmac_sha256, in_domain, mod11_reason
from waitlens.functions.parsing import parse_as
from waitlens.functions.temporal import to_utc
from waitlens.operators import conform
from waitlens.operators.dims import as_of, calendar, dense_key, validity, versions
from waitlens.plans import gold, silver
from waitlens.session import scratch_path
from waitlens.sources import bucketed
from waitlens.sources.files import partition_values
from waitlens.sources.lake import write_partitions
from waitlens.sources.seeds import area_deprivation
from waitlens.sources.keyed import KeyedTable, range_bucket
from workload.registry import query
from workload.roles import TEST_KEY, Roles, digits_sql, hmac_sql, latest_sql, mod11_sql, utc_sql

_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey"


@query(
    "b1_increment",
    """SELECT event_id, CAST(ts AS DATE) AS ingest_date FROM events
       WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events WHERE event_type='view' AND ts < TIMESTAMP '2024-01-20')""",
)
def b1(r: Roles) -> DataFrame:
    """Partitions newer than what a target already holds."""
    path = scratch_path(r.spark, "increment")
    rows = r.raw("events").select("event_id", "event_type", F.col("ts").cast("date").alias("ingest_date"))
    write_partitions(rows, path)
    source = r.spark.read.parquet(path)
    loaded = source.where((F.col("event_type") == "view") & (F.col("ingest_date") < F.lit(date(2024, 1, 20))))
    mark = conform.high_water_mark(loaded, "ingest_date")
    return conform.increment(source, mark).select("event_id", "ingest_date")


@query(
    "b1_late_partition",
    "SELECT event_id, CAST(ts AS DATE) AS ingest_date FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' "
    "OR day(ts) % 7 = 3",
)
def b1_late(r: Roles) -> DataFrame:
    """All partitions up to a day are loaded but some, which landed late and are not lost."""
    path = scratch_path(r.spark, "late")
    rows = r.raw("events").select("event_id", F.col("ts").cast("date").alias("ingest_date"))
    write_partitions(rows, path)
    landed = [date.fromisoformat(d) for d in partition_values(r.spark, path, "ingest_date")]
    loaded = [d for d in landed if d <= date(2024, 1, 20) and d.day % 7 != 3]
    fresh = conform.new_partitions(landed, loaded)
    return r.spark.read.parquet(path).where(F.col("ingest_date").isin(fresh)).select("event_id", "ingest_date")


@query("b2_dedup_latest", latest_sql("SELECT * FROM lineitem", "l_orderkey, l_linenumber", _LINE_ORDER))
def b2(r: Roles) -> DataFrame:
    return conform.dedup_latest(
        r.raw("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey"]
    )


_UPSERT_SQL = (
    """WITH batch AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice+1 AS o_totalprice FROM orders WHERE o_orderstatus='P'
                      UNION ALL SELECT -1-o_orderkey, 'N', o_totalprice FROM orders WHERE o_orderstatus='F')
       SELECT * FROM batch UNION ALL
       SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)"""
)


def _upserted(r: Roles, asked_width: int = 0) -> DataFrame:
    """A table of all orders, and a batch that changes some and adds others."""
    rows = r.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = rows.where("o_orderstatus = 'P'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    added = rows.where("o_orderstatus = 'F'").select(
        (-1 - F.col("o_orderkey")).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice"
    )
    # Some forty buckets, whatever the size of the test table.
    width = max(1, rows.agg(F.max("o_orderkey")).first()[0] // 20)
    path = scratch_path(r.spark, "upsert")
    KeyedTable(r.spark, path, ["o_orderkey"], range_bucket("o_orderkey", width)).merge(rows, ["o_orderkey"])
    table = KeyedTable(r.spark, path, ["o_orderkey"], range_bucket("o_orderkey", asked_width or width))
    table.merge(changed.unionByName(added), ["o_orderkey"])
    return table.read()


@query("b3_upsert", _UPSERT_SQL)
def b3(r: Roles) -> DataFrame:
    return _upserted(r)


@query("b3_changed_width", _UPSERT_SQL)
def b3_changed_width(r: Roles) -> DataFrame:
    """The second writer asks for another bucket width: the stored one stands."""
    return _upserted(r, 7)


@query(
    "b3_type_change",
    """SELECT CAST(o_orderkey AS VARCHAR) AS k, CASE WHEN o_orderstatus='P' THEN -o_totalprice ELSE o_totalprice END AS v FROM orders""",
)
def b3_type_change(r: Roles) -> DataFrame:
    """A key that arrives as a number at first and as text later."""
    rows = r.raw("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"), "o_orderstatus")
    table = KeyedTable(r.spark, scratch_path(r.spark, "retyped"))
    table.merge(rows.drop("o_orderstatus"), ["k"])
    late = rows.where("o_orderstatus = 'P'").select(F.col("k").cast("string").alias("k"), (-F.col("v")).alias("v"))
    table.merge(late, ["k"])
    return table.read()


@query(
    "b4_sync_schema",
    """SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS note FROM orders
       UNION ALL SELECT -1-o_orderkey, o_orderstatus, o_orderpriority FROM orders""",
)
def b4(r: Roles) -> DataFrame:
    """A batch with a new and without an old column."""
    k = F.col("o_orderkey")
    target = r.raw("orders").select(k, "o_orderstatus", "o_totalprice")
    batch = r.raw("orders").select(
        (-1 - k).alias("o_orderkey"), "o_orderstatus", F.col("o_orderpriority").alias("note")
    )
    return conform.sync_schema(target, batch).unionByName(batch)


@query("b5_mod11", f"SELECT patient_id, nhs_pseudo_id, ingest_date, {mod11_sql('nhs_pseudo_id')} AS reason FROM b_patients")
def b5(r: Roles) -> DataFrame:
    return r.patient_demographics.select(
        "patient_id", "nhs_pseudo_id", "ingest_date", mod11_reason(F.col("nhs_pseudo_id")).alias("reason")
    )


@query(
    "b5_mod11_missing",
    f"""SELECT CASE WHEN nhs_pseudo_id IS NULL THEN 'missing' ELSE {mod11_sql('nhs_pseudo_id')} END AS reason,
          count(*) AS n FROM b_patients GROUP BY 1""",
)
def b5_missing(r: Roles) -> DataFrame:
    reason = mod11_reason(F.col("nhs_pseudo_id"), missing_reason="missing").alias("reason")
    return r.patient_demographics.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b6_quarantine_split",
    "SELECT coalesce(reason,'valid') AS outcome, count(*) AS n, count(DISTINCT patient_id) AS patients FROM classified GROUP BY 1",
)
def b6(r: Roles) -> DataFrame:
    valid, rejected = conform.split_by_reason(
        silver.classify_patients(r.patient_demographics, r.ctx), "_reason"
    )
    both = valid.unionByName(rejected)
    return both.groupBy(F.coalesce("_reason", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("patient_id").alias("patients")
    )


@query("b7_hmac", f"SELECT patient_id, ingest_date, {hmac_sql('nhs_pseudo_id')} AS patient_sk FROM b_patients")
def b7(r: Roles) -> DataFrame:
    return r.patient_demographics.select(
        "patient_id", "ingest_date", hmac_sha256(F.col("nhs_pseudo_id"), TEST_KEY).alias("patient_sk")
    )


@query("b8_vault", "SELECT patient_sk, patient_id, date_of_birth, postcode_sector, lsoa_code FROM s_vault")
def b8(r: Roles) -> DataFrame:
    return conform.pick(
        r.vault, ["patient_sk", "patient_id", "date_of_birth", "postcode_sector", "lsoa_code"]
    )


@query(
    "b9_resolve_key",
    """SELECT uc_log_id, v.patient_sk FROM b_urgent u LEFT JOIN s_vault v ON v.patient_id=u.patient_id""",
)
def b9(r: Roles) -> DataFrame:
    rows = r.urgent_care_logs.select("uc_log_id", "patient_id")
    return conform.resolve_key(rows, r.vault, F.col("patient_id"), ["uc_log_id"])


def _bucketed(r: Roles, df: DataFrame, label: str, key: str) -> DataFrame:
    path = scratch_path(r.spark, f"bucketed-{label}")
    return bucketed.write_bucketed(df, f"{label}_{path[-12:]}", path, key, 16)


@query(
    "b9_resolve_bucketed",
    """SELECT uc_log_id, v.patient_sk FROM b_urgent u LEFT JOIN s_vault v ON v.patient_id=u.patient_id""",
)
def b9_bucketed(r: Roles) -> DataFrame:
    """The vault lies in buckets of its key and is not shuffled."""
    vault = _bucketed(r, r.vault.select("patient_id", "patient_sk"), "vault", "patient_id")
    rows = r.urgent_care_logs.select("uc_log_id", "patient_id")
    return bucketed.join_stored(rows, vault, F.col("patient_id"), "patient_id", ["patient_sk"]).drop("patient_id")


@query(
    "f4_references_bucketed",
    """SELECT 'lineitem' AS child, count(*) AS total, count(*) FILTER (o_orderkey IS NULL) AS orphans
         FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON o_orderkey = l_orderkey
       UNION ALL SELECT 'orders', count(*), count(*) FILTER (c_custkey IS NULL)
         FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey""",
)
def f4_bucketed(r: Roles) -> DataFrame:
    """References of two tables to parents of which some are missing."""
    parents = _bucketed(r, r.raw("orders").where("o_orderstatus <> 'P'").select("o_orderkey"), "orders", "o_orderkey")
    payers = _bucketed(r, r.raw("customer").where("c_acctbal > 0").select("c_custkey"), "customer", "c_custkey")
    lines = bucketed.orphans(r.raw("lineitem"), "l_orderkey", parents, "o_orderkey")
    orders = bucketed.orphans(r.raw("orders"), "o_custkey", payers, "c_custkey")
    return lines.select(F.lit("lineitem").alias("child"), "*").unionByName(orders.select(F.lit("orders").alias("child"), "*"))


@query(
    "b10_area_lookup",
    """SELECT patient_id, ingest_date, p.lsoa_code, CAST(l.imd_decile AS INT) AS imd_decile, imd_label, deprivation_level FROM b_patients p
       LEFT JOIN seed_lsoa l ON l.lsoa_code=p.lsoa_code LEFT JOIN seed_imd i ON i.imd_decile=l.imd_decile""",
)
def b10(r: Roles) -> DataFrame:
    rows = r.patient_demographics.select("patient_id", "ingest_date", "lsoa_code")
    return conform.lookup(rows, area_deprivation(r.spark), "lsoa_code")


@query(
    "b11_domain",
    "SELECT patient_id, ingest_date, CASE WHEN sex IN ('M','F','I','U') THEN sex ELSE 'U' END AS sex FROM b_patients",
)
def b11(r: Roles) -> DataFrame:
    return r.patient_demographics.select(
        "patient_id", "ingest_date", in_domain(F.col("sex"), SEX_CODES, "U").alias("sex")
    )


@query(
    "b12_digits",
    f"""SELECT diagnostic_id, request_date, patient_id, {digits_sql('diagnostic_id')} AS id, {digits_sql('encounter_id')} AS encounter
        FROM b_diagnostics""",
)
def b12(r: Roles) -> DataFrame:
    return r.diagnostics_orders.select(
        "diagnostic_id",
        "request_date",
        "patient_id",
        digits_to_bigint(F.col("diagnostic_id")).alias("id"),
        digits_to_bigint(F.col("encounter_id")).alias("encounter"),
    )


@query(
    "b13_to_utc",
    f"SELECT referral_id, updated_at, {utc_sql('referral_datetime')} AS at_utc FROM b_referrals",
)
def b13(r: Roles) -> DataFrame:
    return r.referrals.select("referral_id", "updated_at", to_utc(F.col("referral_datetime")).alias("at_utc"))


@query(
    "b14_strict_casts",
    """SELECT appointment_id, CAST(booking_updated_datetime AS TIMESTAMP) AS updated,
         CAST(CAST(appointment_start_datetime AS TIMESTAMP) AS DATE) AS day, CAST(wait_time_days AS INT) AS wait FROM b_appointments""",
)
def b14(r: Roles) -> DataFrame:


    return r.appointments.select(
        "appointment_id",
        parse_as(F.col("booking_updated_datetime"), "timestamp", "strict").alias("updated"),
        parse_as(F.col("appointment_start_datetime"), "timestamp", "strict").cast("date").alias("day"),
        F.col("wait_time_days").cast("int").alias("wait"),
    )


@query(
    "b15_minimise",
    "SELECT provider_id, provider_code, site_name, site_status, ingest_date FROM b_providers",
)
def b15(r: Roles) -> DataFrame:
    return conform.pick(
        r.provider_site_reference, ["provider_id", "provider_code", "site_name", "site_status", "ingest_date"]
    )


@query(
    "b16_audit_columns",
    """SELECT diagnosis_id, ingest_date AS _ingest_date, TIMESTAMP '2024-06-01' AS stamped FROM b_diagnoses""",
)
def b16(r: Roles) -> DataFrame:
    rows = r.diagnoses.select("diagnosis_id", "ingest_date")
    return conform.with_audit(rows, r.ctx.as_of).withColumnRenamed("_loaded_at", "stamped")


for _name, _table, _attr in (
    ("b20_patients", "s_patients", "s_patients"),
    ("b21_patient_identifiers", "s_vault", "vault"),
    ("b22_patients_quarantine", "s_quarantine", "s_quarantine"),
    ("b23_encounters", "s_encounters", "s_encounters"),
    ("b24_referrals", "s_referrals", "s_referrals"),
    ("b25_diagnoses", "s_diagnoses", "s_diagnoses"),
    ("b26_diagnostics_orders", "s_diagnostics", "s_diagnostics"),
    ("b27_appointments", "s_appointments", "s_appointments"),
    ("b28_urgent_care", "s_urgent", "s_urgent"),
    ("b29_providers", "s_providers", "s_providers"),
    ("c3_dim_patient", "dim_patient", "dim_patient"),
    ("c4_dim_site", "dim_site", "dim_site"),
    ("c5_dim_specialty", "dim_specialty", "dim_specialty"),
):
    query(_name, f"SELECT * FROM {_table}")(lambda r, a=_attr: getattr(r, a))


@query(
    "c1_dim_date",
    """WITH span AS (SELECT date_trunc('year', min(o_orderdate)) AS a, date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS b FROM orders),
          days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
       SELECT CAST(strftime(d,'%Y%m%d') AS INT) AS date_sk, d AS calendar_date, CAST(year(d) AS INT) AS year,
         CAST(month(d) AS INT) AS month, CAST(quarter(d) AS INT) AS quarter, strftime(d,'%Y-%m') AS year_month,
         strftime(d,'%b %Y') AS month_label, CAST(dayofweek(d) AS INT) AS day_of_week, dayofweek(d) IN (0,6) AS is_weekend,
         (SELECT count(*) FROM orders o WHERE CAST(o.o_orderdate AS DATE)=d) AS referrals FROM days""",
)
def c1(r: Roles) -> DataFrame:
    """Referrals per calendar day, over the calendar years the orders touch."""
    placed = F.col("o_orderdate").cast("date")
    ends = r.raw("orders").agg(F.min(placed).alias("a"), F.max(placed).alias("b")).first()
    days = calendar(r.spark, date(ends.a.year, 1, 1), date(ends.b.year, 12, 31))
    counts = r.raw("orders").groupBy(placed.alias("calendar_date")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        days.join(counts, "calendar_date", "left")
        .withColumn("referrals", F.coalesce("_n", F.lit(0)))
        .drop("_n")
    )


@query(
    "c2_dense_key",
    "SELECT row_number() OVER (ORDER BY c_name) AS customer_sk, c_custkey, c_name FROM customer",
)
def c2(r: Roles) -> DataFrame:
    return dense_key(r.raw("customer").select("c_custkey", "c_name"), ["c_name"], "customer_sk")


@query(
    "c3_validity",
    """SELECT patient_id, ingest_date, registration_start_date AS valid_from,
         coalesce(registration_end_date, DATE '9999-12-31') AS valid_to, registration_end_date IS NULL AS is_current FROM b_patients""",
)
def c3(r: Roles) -> DataFrame:
    return validity(r.patient_demographics, "registration_start_date", "registration_end_date").select(
        "patient_id", "ingest_date", "valid_from", "valid_to", "is_current"
    )


# The state of a customer is the priority and status of the latest order so far.
_STATES_SQL = """SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate AS valid_from,
    lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS valid_to FROM (
      SELECT * FROM (
        SELECT *, lag(o_orderpriority || o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS before FROM (
          SELECT o_custkey, o_orderdate, max_by(o_orderpriority, o_orderkey) AS o_orderpriority, max_by(o_orderstatus, o_orderkey) AS o_orderstatus
          FROM orders GROUP BY ALL))
      WHERE before IS DISTINCT FROM o_orderpriority || o_orderstatus)"""


def _states(r: Roles) -> DataFrame:
    return versions(r.raw("orders"), "o_custkey", ["o_orderpriority", "o_orderstatus"], "o_orderdate", ["o_orderkey"])


@query("c3_versions", f"SELECT *, valid_to IS NULL AS is_current FROM ({_STATES_SQL})")
def c3_versions(r: Roles) -> DataFrame:
    """Intervals of each customer's state; repeats of a state open no new one."""
    return _states(r)


@query(
    "c3_as_of",
    f"""SELECT l_orderkey, l_linenumber, s.o_orderpriority, s.o_orderstatus
        FROM (SELECT l_orderkey, l_linenumber, l_shipdate, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey) f
        ASOF LEFT JOIN ({_STATES_SQL}) s ON s.o_custkey = f.o_custkey AND f.l_shipdate >= s.valid_from""",
)
def c3_as_of(r: Roles) -> DataFrame:
    """Each line with the state its customer was in when it was shipped."""
    owners = r.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = r.raw("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate").join(owners, "l_orderkey")
    found = as_of(lines, _states(r), "o_custkey", "l_shipdate", ["o_orderpriority", "o_orderstatus"])
    return found.select("l_orderkey", "l_linenumber", "o_orderpriority", "o_orderstatus")


@query(
    "c6_dim_imd",
    """SELECT row_number() OVER (ORDER BY s.imd_decile) AS imd_sk, CAST(s.imd_decile AS INT) AS imd_decile, s.imd_label, s.deprivation_level,
         (SELECT count(*) FROM b_patients p WHERE p.imd_decile=s.imd_decile) AS patients FROM seed_imd s""",
)
def c6_imd(r: Roles) -> DataFrame:
    counts = r.patient_demographics.groupBy(F.col("imd_decile").cast("int").alias("imd_decile")).agg(
        F.count(F.lit(1)).alias("patients")
    )
    return gold.dim_imd(r.spark).join(counts, "imd_decile", "left").fillna(0, ["patients"])


@query(
    "c6_dim_ethnicity",
    """SELECT row_number() OVER (ORDER BY s.ethnicity_code) AS ethnicity_sk, s.ethnicity_code, s.ethnicity_label, s.ethnicity_group,
         (SELECT count(*) FROM b_patients p WHERE p.ethnicity_ons=s.ethnicity_code) AS patients FROM seed_ethnicity s""",
)
def c6_ethnicity(r: Roles) -> DataFrame:
    counts = r.patient_demographics.groupBy(F.col("ethnicity_ons").alias("ethnicity_code")).agg(
        F.count(F.lit(1)).alias("patients")
    )
    return gold.dim_ethnicity(r.spark).join(counts, "ethnicity_code", "left").fillna(0, ["patients"])
