"""Data tests, readiness checks, profiles."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.contracts import ENTITIES, GOLD_AGE_BANDS, SEX_CODES, TEXT_KEY_ENTITIES
from waitlens.operators import profiling, readiness
from waitlens.operators.quality import (
    Check,
    accepted_values,
    between,
    checked_columns,
    distinct_in_set,
    freshness,
    gate_status,
    grouped_checks,
    not_null,
    row_count,
    run_checks,
    run_suites,
    summarise_runs,
    unique,
    watched,
)
from waitlens.plans.daily import GATE_SUITES
from waitlens.plans.suites import GOLD_SUITES, SILVER_SUITES
from waitlens.session import scratch_path, settle
from waitlens.sources.keyed import range_bucket
from waitlens.sources.keyring import Keyring
from workload.registry import query, rounded
from workload.roles import Roles


def _checked(sql: str) -> str:
    return f"SELECT *, failed=0 AS passed FROM ({sql})"


def _verdicts(r: Roles, table: DataFrame, *checks) -> DataFrame:
    return run_checks(table, "t", list(checks)).select("column_name", "evaluated", "failed", "passed")


@query(
    "e1_not_null",
    _checked(
        """SELECT 'triage_datetime' AS column_name, count(*) AS evaluated, count(*) FILTER (triage_datetime IS NULL) AS failed FROM b_urgent
           UNION ALL SELECT 'departure_datetime', count(*) FILTER (outcome='discharged'),
                 count(*) FILTER (outcome='discharged' AND departure_datetime IS NULL) FROM b_urgent
           UNION ALL SELECT 'arrival_datetime', count(*), count(*) FILTER (arrival_datetime IS NULL) FROM b_urgent"""
    ),
)
def e1(r: Roles) -> DataFrame:
    return _verdicts(
        r,
        r.urgent_care_logs,
        not_null("triage_datetime"),
        not_null("departure_datetime", where="outcome = 'discharged'"),
        not_null("arrival_datetime"),
    )


@query(
    "e2_unique",
    _checked(
        """SELECT 'l_orderkey' AS column_name, CAST(sum(n) AS BIGINT) AS evaluated, count(*) FILTER (n>1) AS failed
             FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
           UNION ALL SELECT 'l_partkey', CAST(sum(n) AS BIGINT), count(*) FILTER (n>1)
             FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey)"""
    ),
)
def e2(r: Roles) -> DataFrame:
    return _verdicts(r, r.raw("lineitem"), unique("l_orderkey"), unique("l_partkey"))


@query(
    "e3_accepted_values",
    _checked(
        """SELECT 'sex' AS column_name, count(*) AS evaluated, count(*) FILTER (sex NOT IN ('M','F','I','U')) AS failed FROM b_patients
           UNION ALL SELECT 'age_band', count(*), count(*) FILTER (age_band NOT IN ('0-15','16-24','25-44','45-64','65-79','80+')) FROM b_patients"""
    ),
)
def e3(r: Roles) -> DataFrame:
    return _verdicts(
        r, r.patient_demographics, accepted_values("sex", SEX_CODES), accepted_values("age_band", GOLD_AGE_BANDS)
    )


@query(
    "e4_between",
    _checked(
        """SELECT 'l_quantity' AS column_name, count(*) AS evaluated, count(*) FILTER (l_quantity NOT BETWEEN 1 AND 49) AS failed FROM lineitem
           UNION ALL SELECT 'l_discount', count(*) FILTER (l_returnflag='R'), count(*) FILTER (l_returnflag='R' AND l_discount>0.05) FROM lineitem"""
    ),
)
def e4(r: Roles) -> DataFrame:
    return _verdicts(
        r,
        r.raw("lineitem"),
        between("l_quantity", 1, 49),
        between("l_discount", high=0.05, where="l_returnflag = 'R'"),
    )


@query(
    "e5_row_count",
    """SELECT check_no, evaluated, evaluated BETWEEN low AND high AS passed FROM (
         SELECT 'labels' AS check_no, count(*) AS evaluated, 1 AS low, 1000000000 AS high FROM labels
         UNION ALL SELECT 'nation', count(*), 26, 30 FROM nation)""",
)
def e5(r: Roles) -> DataFrame:
    both = run_checks(r.raw("labels"), "labels", [row_count(1)]).unionByName(
        run_checks(r.raw("nation"), "nation", [row_count(26, 30)])
    )
    return both.select(F.col("table_name").alias("check_no"), "evaluated", "passed")


@query(
    "e6_compound_unique",
    _checked(
        """SELECT 'l_orderkey,l_linenumber' AS column_name, CAST(sum(n) AS BIGINT) AS evaluated, count(*) FILTER (n>1) AS failed
           FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
    ),
)
def e6(r: Roles) -> DataFrame:
    return _verdicts(r, r.raw("lineitem"), unique("l_orderkey", "l_linenumber"))


@query(
    "e7_not_null_mostly",
    """SELECT 'patient_sk' AS column_name, count(*) AS evaluated, count(*) FILTER (patient_sk IS NULL) AS failed,
         count(patient_sk) >= 0.80*count(*) AS passed FROM s_referrals""",
)
def e7(r: Roles) -> DataFrame:
    return _verdicts(r, r.s_referrals, not_null("patient_sk", mostly=0.80))


@query(
    "e8_distinct_in_set",
    _checked(
        """SELECT 'event_type' AS column_name, count(*) AS evaluated, count(*) FILTER (event_type NOT IN ('view','click','purchase')) AS failed
           FROM (SELECT DISTINCT event_type FROM events)"""
    ),
)
def e8(r: Roles) -> DataFrame:
    return _verdicts(r, r.raw("events"), distinct_in_set("event_type", ["view", "click", "purchase"]))


def _suite_sql(table: str, broken: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CASE WHEN ({broken})>0 THEN 'FAILED' ELSE 'PASSED' END AS run_status, "
        f"CAST(({broken}) AS INT) AS failure_count"
    )


_FEW_KEYS = "(SELECT CAST(count(*)=0 AS INT) + CAST(count({id})<count(*) AS INT) + CAST(count(patient_sk)<0.80*count(*) AS INT) FROM {t})"
_SUITES_SQL = " UNION ALL ".join(
    (
        _suite_sql(
            "patients",
            "(SELECT CAST(count(*)=0 AS INT) + CAST(count(patient_sk)<count(*) AS INT) "
            "+ CAST(count(*) FILTER (sex NOT IN ('M','F','I','U'))>0 AS INT) FROM s_patients)",
        ),
        _suite_sql("encounters", _FEW_KEYS.format(id="encounter_id", t="s_encounters")),
        _suite_sql("referrals", _FEW_KEYS.format(id="referral_id", t="s_referrals")),
        _suite_sql("diagnoses", "(SELECT CAST(count(diagnosis_id)<count(*) AS INT) FROM s_diagnoses)"),
    )
)


def _suite_runs(r: Roles) -> DataFrame:
    tables = {
        "patients": r.s_patients,
        "encounters": r.s_encounters,
        "referrals": r.s_referrals,
        "diagnoses": r.s_diagnoses,
    }
    return run_suites(r.spark, tables, GATE_SUITES, "run", date(2024, 6, 1))


@query("e9_suite_runs", _SUITES_SQL)
def e9(r: Roles) -> DataFrame:
    return _suite_runs(r).select("table_name", "run_status", "failure_count")


# Where each tested table is in Spark and in SQL.
_TESTED = {
    "patients": ("s_patients", "s_patients"), "patient_identifiers": ("vault", "s_vault"),
    "patients_quarantine": ("s_quarantine", "s_quarantine"), "encounters": ("s_encounters", "s_encounters"),
    "referrals": ("s_referrals", "s_referrals"), "diagnoses": ("s_diagnoses", "s_diagnoses"),
    "diagnostics_orders": ("s_diagnostics", "s_diagnostics"), "appointments": ("s_appointments", "s_appointments"),
    "urgent_care": ("s_urgent", "s_urgent"), "providers": ("s_providers", "s_providers"),
    "dim_patient": ("dim_patient", "dim_patient"), "dim_site": ("dim_site", "dim_site"),
    "dim_specialty": ("dim_specialty", "dim_specialty"), "fct_wait_times": ("waits", "fct_wait_times"),
    "fct_urgent_care": ("urgent", "fct_urgent_care"), "fct_utilisation": ("utilisation", "fct_utilisation"),
    "fct_inequality": ("inequality", "fct_inequality"),
}


def _literal(value) -> str:
    return str(value) if not isinstance(value, str) else f"'{value}'"


def check_sql(table: str, source: str, check: Check) -> str:
    """One declared check, said in SQL."""
    scope = check.where or "TRUE"
    column = check.columns[0] if check.columns else ""
    rows = f"count(*) FILTER ({scope})"
    if check.kind in ("unique", "compound_unique"):
        some = f"{column} IS NOT NULL" if check.kind == "unique" else "TRUE"
        counts = f"coalesce(sum(n), 0) AS evaluated, count(*) FILTER (n > 1) AS failed FROM (SELECT count(*) AS n FROM {source} WHERE {some} GROUP BY {', '.join(check.columns)})"
    else:
        bad = {
            "row_count": "FALSE",
            "not_null": f"{column} IS NULL",
            "accepted_values": f"{column} NOT IN ({', '.join(map(_literal, check.values))})",
            "between": f"{column} NOT BETWEEN {check.low} AND {check.high}",
        }[check.kind]
        counts = f"{rows} AS evaluated, count(*) FILTER (({scope}) AND {bad}) AS failed FROM {source}"
    if check.kind == "row_count":
        ok = f"evaluated >= {check.low}" + (f" AND evaluated <= {check.high}" if check.high else "")
    else:
        ok = "failed = 0"
    return (
        f"SELECT '{table}' AS table_name, '{check.kind}' AS check_name, '{check.label}' AS column_name, '{check.severity}' AS severity, "
        f"CAST(evaluated AS BIGINT) AS evaluated, failed, {ok} AS passed FROM (SELECT {counts})"
    )


# Of the wide tables, the columns that others of the list are made from.
_PASSED_ON = {
    "patient_identifiers": ("patient_id", "patient_sk"),
    "patients_quarantine": (),
    "encounters": ("patient_sk", "encounter_datetime_start", "wait_time_days", "was_attended"),
    "referrals": (
        "referral_id", "patient_sk", "target_provider_id", "referral_datetime", "referral_specialty", "status",
    ),
    "diagnoses": (),
    "diagnostics_orders": ("referral_id", "request_date", "result_date"),
    "fct_wait_times": ("patient_sk", "treatment_month", "wait_days"),
    "fct_urgent_care": ("patient_sk", "arrival_month", "four_hour_breach_flag"),
    "fct_utilisation": (),
    "fct_inequality": (),
}
_DECLARED = {n: c for n, c in (SILVER_SUITES | GOLD_SUITES).items() if n in _TESTED}


@query(
    "e9_declared_checks",
    " UNION ALL ".join(check_sql(n, _TESTED[n][1], c) for n, checks in _DECLARED.items() for c in checks),
)
def e9_declared(r: Roles) -> DataFrame:
    """Every declared test of every table that follows the data, a row each."""
    # Plain checks are counted while a table is written; what is written is the columns that
    # the other checks and later tables need, so no table is made twice.
    parts = []
    for n, (name, _) in _TESTED.items():
        table, checks = getattr(r, name), _DECLARED[n]
        passed_on = _PASSED_ON.get(n, table.columns)
        kept = {*checked_columns(grouped_checks(checks)), *passed_on}
        if not kept:
            parts.append(run_checks(table, n, checks))
            continue
        wanted = {*checked_columns(checks), *passed_on}
        seen, found = watched(table.select(*[c for c in table.columns if c in wanted]), n, checks)
        settled = settle(seen.select(*[c for c in table.columns if c in kept]))
        setattr(r, name, settled)
        parts.append(run_checks(settled, n, checks, found()))
    return reduce(DataFrame.unionByName, parts)


_STRAYS = "SELECT count(*) FILTER (age_band NOT IN ('0-15')) AS n FROM b_patients"


@query(
    "e9_severity",
    f"""SELECT 'silver' AS table_name, 'PASSED' AS run_status, 0 AS failure_count FROM ({_STRAYS})
       UNION ALL SELECT 'gold', CASE WHEN n > 0 THEN 'FAILED' ELSE 'PASSED' END, CAST(n > 0 AS INT) FROM ({_STRAYS})""",
)
def e9_severity(r: Roles) -> DataFrame:
    """The same finding as a warning and as an error."""
    rows = r.patient_demographics
    results = run_checks(rows, "silver", [accepted_values("age_band", ["0-15"], severity="warn")]).unionByName(
        run_checks(rows, "gold", [accepted_values("age_band", ["0-15"])])
    )
    runs = summarise_runs(results, "run", date(2024, 6, 1))
    return runs.select("table_name", "run_status", "failure_count")


@query(
    "e10_gate",
    f"""SELECT count(*) FILTER (run_status='FAILED') AS failures, count(*) AS total_runs,
          count(*) FILTER (run_status='FAILED')>0 OR count(*)=0 AS blocked FROM ({_SUITES_SQL})""",
)
def e10(r: Roles) -> DataFrame:
    return gate_status(_suite_runs(r), date(2024, 6, 1))


@query(
    "e11_freshness",
    """SELECT latest, CAST(datediff('day', latest, DATE '2024-02-02') AS INT) AS age_days,
         CASE WHEN datediff('day', latest, DATE '2024-02-02')>3 THEN 'error' WHEN datediff('day', latest, DATE '2024-02-02')>2 THEN 'warn' ELSE 'ok' END AS status
       FROM (SELECT CAST(max(ts) AS DATE) AS latest FROM events)""",
)
def e11(r: Roles) -> DataFrame:
    return freshness(r.urgent_care_logs, date(2024, 2, 2))


_TABLES = (
    ("patient_demographics", "b_patients"),
    ("encounters", "b_encounters"),
    ("referrals", "b_referrals"),
    ("diagnoses", "b_diagnoses"),
    ("appointments", "b_appointments"),
    ("urgent_care_logs", "b_urgent"),
    ("diagnostics_orders", "b_diagnostics"),
    ("provider_site_reference", "b_providers"),
)


def _six(r: Roles) -> dict[str, DataFrame]:
    """The Bronze entities without two: one of them missing, one empty."""
    frames = dict(r.bronze)
    del frames["diagnoses"]
    frames["appointments"] = frames["appointments"].where("appointment_id IS NULL")
    return frames


@query(
    "f1_completeness",
    " UNION ALL ".join(
        f"SELECT '{n}' AS entity, FALSE AS passed, 'entity missing' AS detail"
        if n == "diagnoses"
        else f"SELECT '{n}' AS entity, count(*)>0 AS passed, 'rows='||count(*) AS detail FROM {t}"
        + (" WHERE appointment_id IS NULL" if n == "appointments" else "")
        for n, t in _TABLES
    ),
)
def f1(r: Roles) -> DataFrame:
    return readiness.completeness(r.spark, _six(r)).drop("check_name")


_KEYS_SQL = (
    " UNION ALL ".join(
        f"SELECT '{n}' AS entity, 'nulls='||(count(*)-count({ENTITIES[n].pk}))||', duplicates='||"
        f"(count(*)-count(DISTINCT {ENTITIES[n].pk})-CAST(count(*)>count({ENTITIES[n].pk}) AS INT))||', rows='||count(*) AS detail, "
        f"count(*)=count(DISTINCT {ENTITIES[n].pk}) AS passed FROM {t}"
        for n, t in _TABLES
    )
)


@query("f2_primary_keys", _KEYS_SQL)
def f2(r: Roles) -> DataFrame:
    return readiness.primary_keys(r.spark, r.bronze).drop("check_name")


_NULLS_SQL = (
    """SELECT 'encounters' AS entity, FALSE AS passed, 'column=patient_id nulls='||(count(*)-count(patient_id)) AS detail
         FROM b_encounters HAVING count(*)>count(patient_id)
       UNION ALL SELECT 'referrals', FALSE, 'column=target_provider_id nulls='||(count(*)-count(target_provider_id))
         FROM b_referrals HAVING count(*)>count(target_provider_id)
       UNION ALL SELECT 'patient_demographics', TRUE, 'WARN column=registration_end_date nulls='||(count(*)-count(registration_end_date))
         FROM b_patients HAVING (count(*)-count(registration_end_date))*100.0/count(*)>50"""
)


@query("f3_null_rates", _NULLS_SQL)
def f3(r: Roles) -> DataFrame:
    return readiness.null_rates(r.spark, r.bronze).drop("check_name")


_PARENTS = {n: t for n, t in _TABLES}


_REFERENCES_SQL = (
    " UNION ALL ".join(
        f"SELECT '{c}' AS entity, '{cc} -> {p}.{pc}: orphans='||count(*) FILTER (k.id IS NULL)||'/'||count(*) AS detail, "
        f"count(*) FILTER (k.id IS NULL)=0 AS passed FROM (SELECT DISTINCT CAST({cc} AS VARCHAR) AS id FROM {_PARENTS[c]} WHERE {cc} IS NOT NULL) h "
        f"LEFT JOIN (SELECT DISTINCT CAST({pc} AS VARCHAR) AS id FROM {_PARENTS[p]}) k ON k.id=h.id"
        for c, cc, p, pc in readiness.FOREIGN_KEYS
    )
)


@query("f4_references", _REFERENCES_SQL)
def f4(r: Roles) -> DataFrame:
    return readiness.references(r.spark, r.bronze).drop("check_name")


_OTHER_SPANS = (
    "SELECT 'urgent_care_logs', "
    + ", ".join(
        f"{pick}({','.join(f'{end}({c})' for c in ('arrival_datetime', 'triage_datetime', 'seen_by_clinician_datetime', 'departure_datetime', 'created_at', 'updated_at'))})"
        for pick, end in (("least", "min"), ("greatest", "max"))
    )
    + " FROM b_urgent",
)
_SPANS = " UNION ALL ".join(
    (
        "SELECT 'patient_demographics' AS entity, min(updated_at) AS lo, max(updated_at) AS hi FROM b_patients",
        "SELECT 'encounters', least(min(encounter_datetime_start),min(encounter_datetime_end),min(created_at),min(updated_at)), "
        "greatest(max(encounter_datetime_start),max(encounter_datetime_end),max(created_at),max(updated_at)) FROM b_encounters",
        "SELECT 'referrals', least(min(referral_datetime),min(created_at),min(updated_at)), "
        "greatest(max(referral_datetime),max(created_at),max(updated_at)) FROM b_referrals",
        "SELECT 'diagnoses', least(min(coded_datetime),min(clinical_datetime),min(created_at),min(updated_at)), "
        "greatest(max(coded_datetime),max(clinical_datetime),max(created_at),max(updated_at)) FROM b_diagnoses",
        *_OTHER_SPANS,
    )
)


_OVERLAP_SQL = (
    f"""WITH s AS ({_SPANS}), o AS (SELECT max(lo) AS a, min(hi) AS b, count(*) AS n FROM s),
          c AS (SELECT s.*, s.lo<=o.b AND s.hi>=o.a AS covers FROM s, o)
        SELECT entity, covers AS passed, 'range='||CAST(lo AS DATE)||' to '||CAST(hi AS DATE) AS detail FROM c
        UNION ALL SELECT 'all', (SELECT a<=b FROM o) AND count(*) FILTER (covers)>=3, 'overlapping_entities='||count(*) FILTER (covers) FROM c"""
)


@query("f5_date_overlap", _OVERLAP_SQL)
def f5(r: Roles) -> DataFrame:
    return readiness.date_overlap(r.spark, r.bronze).drop("check_name")


def _kinds_sql(key: str, holders) -> str:
    """(entity, kind) of a key's holders, if they do not agree."""
    each = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, CASE typeof(any_value({key})) WHEN 'VARCHAR' THEN 'string' ELSE lower(typeof(any_value({key}))) END AS kind, "
        f"count(*)>0 AS has_rows, {e in TEXT_KEY_ENTITIES} AS text_known FROM {_PARENTS[e]}"
        for e in holders
    )
    return f"SELECT * FROM ({each}) QUALIFY min(kind) OVER () <> max(kind) OVER ()"


_KEY_ROWS = " UNION ALL ".join(
    f"SELECT 'join_key_existence' AS check_name, '{e}' AS entity, count({key})>=0 AS passed, 'column={key} present=True' AS detail, "
    f"count(*)>0 AS has_rows FROM {_PARENTS[e]}"
    for key, holders in readiness.JOIN_KEY_HOLDERS.items()
    for e in holders
)
_KIND_ROWS = " UNION ALL ".join(
    f"SELECT 'type_consistency' AS check_name, entity, text_known AND kind='string' AS passed, "
    f"CASE WHEN text_known AND kind='string' THEN 'WARN ' ELSE '' END||'column={key} type='||kind AS detail, has_rows FROM ({_kinds_sql(key, holders)})"
    for key, holders in readiness.JOIN_KEY_HOLDERS.items()
)
_REPORT_SQL = " UNION ALL ".join(
    [f"SELECT 'entity_completeness' AS check_name, '{n}' AS entity, count(*)>0 AS passed, 'rows='||count(*) AS detail FROM {t}" for n, t in _TABLES]
    + [
        f"SELECT '{check}', entity, passed, detail FROM ({sql})"
        for check, sql in (
            ("pk_unique_nonnull", _KEYS_SQL),
            ("null_rate", _NULLS_SQL),
            ("referential_integrity", _REFERENCES_SQL),
            ("date_range_coverage", _OVERLAP_SQL),
        )
    ]
    + [f"SELECT check_name, entity, passed, detail FROM ({_KEY_ROWS})", f"SELECT check_name, entity, passed, detail FROM ({_KIND_ROWS})"]
)


@query("f6_readiness_report", _REPORT_SQL)
def f6(r: Roles) -> DataFrame:
    return readiness.readiness_report(r.spark, r.bronze)


@query(
    "f6_readiness_verdict",
    f"""SELECT count(*) AS checks, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed,
          count(*) FILTER (NOT passed)=0 AS ready FROM ({_REPORT_SQL})""",
)
def f6_verdict(r: Roles) -> DataFrame:
    return readiness.readiness_verdict(readiness.readiness_report(r.spark, r.bronze))


@query(
    "f6_key_contracts",
    f"SELECT check_name, entity, passed, has_rows FROM ({_KEY_ROWS}) UNION ALL SELECT check_name, entity, passed, has_rows FROM ({_KIND_ROWS})",
)
def f6_contracts(r: Roles) -> DataFrame:
    """The two checks on schemas, next to whether the entity has rows."""
    rows = readiness.completeness(r.spark, r.bronze).select("entity", F.col("passed").alias("has_rows"))
    both = readiness.join_keys_present(r.spark, r.bronze).unionByName(readiness.key_types(r.spark, r.bronze))
    return both.drop("detail").join(rows, "entity")


# Column, type, and how its range is compared: as a number, as a moment, or not at all.
_PROFILED = (
    ("l_orderkey", "bigint", "n"), ("l_partkey", "bigint", "n"), ("l_suppkey", "bigint", "n"),
    ("l_linenumber", "int", "n"), ("l_quantity", "double", "n"), ("l_extendedprice", "double", "n"),
    ("l_discount", "double", "n"), ("l_tax", "double", "n"), ("l_returnflag", "string", ""),
    ("l_linestatus", "string", ""), ("l_shipdate", "timestamp_ntz", "t"),
)
_AS = {"n": "CAST({} AS DOUBLE)", "t": "CAST(epoch({}) AS DOUBLE)", "": "NULL::DOUBLE"}


@query(
    "f7_column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, round(count({c})*100.0/count(*),6) AS non_null_pct, "
        f"count(DISTINCT {c}) AS distinct_count, {_AS[how].format(f'min({c})')} AS min_value, "
        f"{_AS[how].format(f'max({c})')} AS max_value FROM lineitem"
        for c, kind, how in _PROFILED
    ),
)
def f7(r: Roles) -> DataFrame:
    profile = profiling.column_profile(r.raw("lineitem"))
    as_number = lambda c: F.when(
        F.col("data_type") == "timestamp_ntz", F.unix_timestamp(F.col(c).try_cast("timestamp")).cast("double")
    ).otherwise(F.col(c).try_cast("double"))
    return rounded(profile.withColumns({c: as_number(c) for c in ("min_value", "max_value")}), "non_null_pct")


@query(
    "f8_entity_profile",
    """SELECT 'referrals' AS entity, 'ehr_postgres' AS source, count(*) AS row_count, 'referral_id' AS pk,
         count(DISTINCT referral_id)=count(referral_id) AS pk_unique, count(*)-count(referral_id) AS pk_null_count,
         least(min(referral_datetime),min(created_at),min(updated_at)) AS range_start,
         greatest(max(referral_datetime),max(created_at),max(updated_at)) AS range_end FROM b_referrals""",
)
def f8(r: Roles) -> DataFrame:
    entity = ENTITIES["referrals"]
    return profiling.entity_profile(r.referrals, entity.name, entity.pk, entity.source)


@query(
    "f9_gaps",
    """SELECT 'type_mismatch' AS gap, c AS column_name FROM b_diagnostics, (VALUES ('request_date'),('performed_date'),('result_date')) t(c)
         GROUP BY c HAVING count(*)>0
       UNION ALL SELECT 'high_nulls', 'result_date' FROM b_diagnostics HAVING count(result_date)*100.0/count(*)<90
       UNION ALL SELECT 'high_nulls', 'performed_date' FROM b_diagnostics HAVING count(performed_date)*100.0/count(*)<90
       UNION ALL SELECT 'join_keys', NULL FROM b_diagnostics HAVING count(*)>0
       UNION ALL SELECT 'pk_duplicates', 'diagnostic_id' FROM b_diagnostics HAVING count(DISTINCT diagnostic_id)<count(diagnostic_id)""",
)
def f9(r: Roles) -> DataFrame:
    entity = ENTITIES["diagnostics_orders"]
    rows = r.diagnostics_orders.drop("ingest_date")
    gaps = profiling.gap_rows(
        profiling.column_profile(rows),
        profiling.entity_profile(rows, entity.name, entity.pk, entity.source),
        entity,
    )
    return gaps.select("gap", "column_name")


@query(
    "e2_incremental_unique",
    """WITH b AS (SELECT o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1994-01-01' THEN 'a' WHEN o_orderdate < TIMESTAMP '1996-06-01' THEN 'b' ELSE 'c' END AS batch FROM orders),
          n AS (SELECT batch, o_custkey, count(*) AS n FROM b GROUP BY ALL),
          f AS (SELECT *, min(batch) OVER (PARTITION BY o_custkey) AS first FROM n)
        SELECT batch, o_custkey, n, CASE WHEN first < batch THEN first END AS seen_in FROM f WHERE n > 1 OR first < batch""",
)
def e2_incremental(r: Roles) -> DataFrame:
    """Customers that order again, in the same batch of orders or after an earlier one."""
    orders = r.raw("orders").select("o_custkey", "o_orderdate")
    width = max(1, r.raw("customer").agg(F.max("c_custkey")).first()[0] // 20)
    ring = Keyring(r.spark, scratch_path(r.spark, "keyring"), "o_custkey", range_bucket("o_custkey", width))
    cut = [F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in ("1994-01-01", "1996-06-01")]
    at = F.col("o_orderdate")
    batches = {"a": at < cut[0], "b": (at >= cut[0]) & (at < cut[1]), "c": (at >= cut[1]) | at.isNull()}
    parts = [ring.add(orders.where(which), name).select(F.lit(name).alias("batch"), "*") for name, which in batches.items()]
    return reduce(DataFrame.unionByName, parts)
