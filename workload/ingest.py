"""Scans, landings, historical loads, manifests, exports."""

from __future__ import annotations

from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.contracts import ENTITIES
from waitlens.operators.dims import calendar
from waitlens.operators.quality import not_null, row_count, run_suites, unique
from waitlens.plans import gold
from waitlens.plans.daily import Paths
from waitlens.plans.historical import load_history
from waitlens.session import scratch_path, settle, settled_folder
from waitlens.sources import drops, exports, lake, manifests
from waitlens.sources.seeds import load_seed
from workload.registry import query
from workload.roles import Roles


@query(
    "a1_read_bronze",
    """SELECT ingest_date, count(*) AS n, count(patient_id) AS with_patient,
              min(encounter_datetime_start) AS first_start
       FROM b_encounters WHERE ingest_date IN (DATE '1996-03-01', DATE '1998-07-01') GROUP BY ingest_date""",
)
def a1(r: Roles) -> DataFrame:
    root = scratch_path(r.spark, "bronze")
    lake.write_bronze(r.encounters, root, ENTITIES["encounters"])
    days = [date(1996, 3, 1), date(1998, 7, 1)]
    return lake.read_bronze(r.spark, root, ENTITIES["encounters"], days).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("patient_id").alias("with_patient"),
        F.min("encounter_datetime_start").alias("first_start"),
    )


@query(
    "a2_business_date_slice",
    "SELECT event_id, ts, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'",
)
def a2(r: Roles) -> DataFrame:
    return lake.slice_by_date(r.raw("events"), "ts", date(2024, 1, 10)).select("event_id", "ts", "event_type")


@query(
    "a3_snapshot",
    """SELECT c_custkey, c_name, c_nationkey, c_mktsegment, DATE '2024-02-01' AS ingest_date FROM customer""",
)
def a3(r: Roles) -> DataFrame:
    path = scratch_path(r.spark, "snapshot")
    rows = r.raw("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    lake.write_partitions(lake.snapshot(rows, date(2024, 2, 1)), path)
    return r.spark.read.parquet(path)


@query(
    "a4_land_csv",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(lang,'') AS lang,
              CASE WHEN doc_id%3=0 THEN '' ELSE source END AS source,
              regexp_replace(text, '\\r\\n|\\r', chr(10), 'g') AS text FROM documents""",
)
def a4(r: Roles) -> DataFrame:
    """Documents through a CSV drop: commas, quotes and line breaks in the text."""
    path = scratch_path(r.spark, "drop")
    newlines = F.regexp_replace("text", "\r\n|\r", "\n")
    rows = r.raw("documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("source")).alias("source"),
        newlines.alias("text"),
    )
    rows.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "emptyValue", ""
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return drops.land_csv(r.spark, path, multi_line=True).drop("file_name")


@query(
    "a5_export_dates",
    """SELECT {m} AS ingest_date, count(*) AS n, count(DISTINCT o_orderpriority) AS priorities
       FROM orders GROUP BY 1""".format(m="CAST(date_trunc('year', o_orderdate) AS DATE)"),
)
def a5(r: Roles) -> DataFrame:
    root = scratch_path(r.spark, "exports")
    year = F.trunc(F.col("o_orderdate").cast("date"), "YEAR")
    rows = r.raw("orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        "o_orderpriority",
        F.date_format(year, "yyyyMMdd").alias("export_date"),
    )
    rows.write.partitionBy("export_date").option("header", True).csv(root)
    landed = drops.land_exports(r.spark, root)
    return landed.groupBy("ingest_date").agg(
        F.count("id").alias("n"), F.count_distinct("o_orderpriority").alias("priorities")
    )


@query(
    "a6_backfill_partitions",
    """SELECT CASE WHEN d < DATE '1999-01-01' THEN DATE '1999-01-01' ELSE d END AS ingest_date, count(*) AS n
       FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_quantity >= 2) GROUP BY 1""",
)
def a6(r: Roles) -> DataFrame:
    shipped = F.when(F.col("l_quantity") >= 2, F.col("l_shipdate"))
    rows = r.raw("lineitem").select("l_orderkey", "l_linenumber", shipped.alias("shipped"))
    dated, _ = lake.backfill(rows, "shipped", date(1999, 1, 1))
    path = scratch_path(r.spark, "backfill")
    lake.write_partitions(dated, path)
    return r.spark.read.parquet(path).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a6_backfill_rejects",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_quantity < 2",
)
def a6_rejects(r: Roles) -> DataFrame:
    shipped = F.when(F.col("l_quantity") >= 2, F.col("l_shipdate"))
    rows = r.raw("lineitem").withColumn("shipped", shipped)
    _, rejected = lake.backfill(rows, "shipped", date(1999, 1, 1))
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _named_by_file(r: Roles) -> DataFrame:
    """Rows named by the file they would arrive in; one name in ten holds no date."""
    month = F.date_format(F.trunc(F.col("o_orderdate").cast("date"), "MM"), "yyyyMMdd")
    name = F.concat(F.when(F.col("o_orderkey") % 10 != 0, month).otherwise("undated1"), F.lit("_orders.csv"))
    return r.raw("orders").select("o_orderkey", name.alias("file_name"))


@query(
    "a7_file_dated_backfill",
    """SELECT CASE WHEN d < DATE '1998-01-01' THEN DATE '1998-01-01' ELSE d END AS ingest_date, count(*) AS n
       FROM (SELECT CASE WHEN o_orderkey%10<>0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS d
             FROM orders) WHERE d IS NOT NULL GROUP BY 1""",
)
def a7(r: Roles) -> DataFrame:
    rows = _named_by_file(r)
    dated, _ = lake.backfill_by_file_name(rows, date(1998, 1, 1))
    return dated.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a7_rejects",
    "SELECT o_orderkey, 'undated1_orders.csv' AS file_name FROM orders WHERE o_orderkey % 10 = 0",
)
def a7_rejects(r: Roles) -> DataFrame:
    """The rows of the same load whose file names hold no date."""
    _, rejected = lake.backfill_by_file_name(_named_by_file(r), date(1998, 1, 1))
    return rejected


@query(
    "a8_coerce",
    """SELECT event_id, try_cast(CASE WHEN event_id%5=0 THEN 'soon' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS moment,
         try_cast(CASE WHEN event_id%7=0 THEN '' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS DATE) AS day,
         CASE WHEN event_id%3=0 OR event_id%11=0 OR event_id%13=0 THEN NULL ELSE event_id END AS n,
         CASE event_id%8 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN TRUE WHEN 3 THEN FALSE WHEN 4 THEN FALSE
              WHEN 5 THEN FALSE END AS flag,
         CAST(user_id AS VARCHAR) AS who, TIMESTAMP '2024-06-01' AS updated_at
       FROM events""",
)
def a8(r: Roles) -> DataFrame:
    k = F.col("event_id")
    words = ["True", "true", "1", "False", "false", "0", "yes", "TRUE"]
    flag = F.element_at(F.array(*[F.lit(w) for w in words]), (k % 8 + 1).cast("int"))
    text = r.raw("events").select(
        "event_id",
        F.when(k % 5 == 0, "soon").otherwise(F.col("ts").cast("string")).alias("moment"),
        F.when(k % 7 == 0, "").otherwise(F.col("ts").cast("date").cast("string")).alias("day"),
        F.when(k % 3 == 0, "n/a")
        .when(k % 11 == 0, F.concat(k.cast("string"), F.lit(".5")))
        .when(k % 13 == 0, F.concat(k.cast("string"), F.lit(".0000000000001")))
        .otherwise(F.concat(k.cast("string"), F.lit(".0")))
        .alias("n"),
        flag.alias("flag"),
        F.col("user_id").alias("who"),
    )
    types = {
        "moment": "timestamp", "day": "date", "n": "int64", "flag": "bool", "who": "str",
        "updated_at": "timestamp",
    }
    return lake.coerce(text, types, now=F.lit("2024-06-01 00:00:00").cast("timestamp_ntz"))


#: Keys to a file of the drop.
_FILE_KEYS = 20_000


@query(
    "a9_file_inventory",
    f"""SELECT CAST(part AS VARCHAR) AS folder, strlen(body) AS bytes, sha256(body) AS sha256 FROM (
         SELECT o_orderkey // {_FILE_KEYS} AS part,
           'o_orderkey,o_orderstatus'||chr(10)||string_agg(o_orderkey||','||o_orderstatus||chr(10), '' ORDER BY o_orderkey) AS body
         FROM orders GROUP BY 1)""",
)
def a9(r: Roles) -> DataFrame:
    """Size and digest of the files of a drop: a range of order keys each, so files grow in number."""
    path = scratch_path(r.spark, "inventory")
    part = F.floor(F.col("o_orderkey") / _FILE_KEYS).alias("folder")
    rows = r.raw("orders").select("o_orderkey", "o_orderstatus", part)
    by_range = rows.repartition("folder").sortWithinPartitions("folder", "o_orderkey")
    by_range.write.partitionBy("folder").option("header", True).csv(path)
    return drops.inventory(r.spark, f"{path}/folder=*/*.csv", with_path=True).select(
        F.regexp_extract("path", "folder=([0-9]+)/", 1).alias("folder"), "bytes", "sha256"
    )


# Where each entity is in SQL, and what dates its rows: a column, or the file it came in.
_EXTRACTS = {
    "patient_demographics": ("b_patients", "registration_start_date"), "encounters": ("b_encounters", "encounter_datetime_start"),
    "referrals": ("b_referrals", "referral_datetime"), "diagnoses": ("b_diagnoses", "clinical_datetime"),
    "urgent_care_logs": ("b_urgent", "arrival_datetime"), "appointments": ("b_appointments", None),
    "diagnostics_orders": ("b_diagnostics", None), "provider_site_reference": ("b_providers", None),
}
_HISTORY_SQL = " UNION ALL ".join(
    f"SELECT '{n}' AS entity, '{ENTITIES[n].source}' AS source, count({c or 'ingest_date'}) AS landed, "
    f"count(*)-count({c or 'ingest_date'}) AS rejected, greatest(CAST(max({c or 'ingest_date'}) AS DATE), DATE '2023-01-01') AS last FROM {t}"
    for n, (t, c) in _EXTRACTS.items()
)


@query(
    "a6_historical_load",
    f"""SELECT entity, CAST(landed AS BIGINT) AS landed, CAST(rejected AS BIGINT) AS rejected,
          CAST(max(last) OVER (PARTITION BY source) + 1 AS DATE) AS next_date FROM ({_HISTORY_SQL})""",
)
def a6_historical(r: Roles) -> DataFrame:
    """All eight extracts loaded as text, three of them dated by their file; afterwards each
    source knows its next date."""
    paths = Paths(scratch_path(r.spark, "history"))

    def extract(name: str) -> DataFrame:
        df = r.bronze[name]
        text = [F.col(c).cast("string").alias(c) for c in df.columns if c != "ingest_date"]
        stem = F.coalesce(F.date_format("ingest_date", "yyyyMMdd"), F.lit("undated"))
        file = [F.concat(stem, F.lit(f"_{name}.csv")).alias("file_name")] if _EXTRACTS[name][1] is None else []
        return df.select(*text, *file)

    loaded = load_history(r.spark, paths, {n: partial(extract, n) for n in _EXTRACTS}, date(2023, 1, 1))
    sources = F.create_map(*[F.lit(x) for n in _EXTRACTS for x in (n, ENTITIES[n].source)])
    latest = manifests.latest_success(manifests.read_manifests(r.spark, paths.manifests))
    return (
        loaded.withColumn("source", F.element_at(sources, F.col("entity")))
        .join(latest, "source", "left")
        .select("entity", "landed", "rejected", F.date_add("latest", 1).alias("next_date"))
    )


_RUNS = """SELECT event_type AS source, CAST(ts AS DATE) AS ingest_date,
             printf('%09d', event_id) AS run_id,
             CASE event_id%5 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' WHEN 2 THEN NULL ELSE 'success' END AS status,
             ts AS modified_at FROM events"""


def _runs(r: Roles) -> DataFrame:
    """Each event as the manifest of one run."""
    k = F.col("event_id")
    return r.raw("events").select(
        F.col("event_type").alias("source"),
        F.col("ts").cast("date").alias("ingest_date"),
        F.format_string("%09d", k).alias("run_id"),
        F.when(k % 5 == 0, "failed").when(k % 5 == 1, "skipped").when(k % 5 > 2, "success").alias("status"),
        F.col("ts").alias("modified_at"),
    )


@query(
    "a10_run_manifest",
    """SELECT o_orderpriority AS source, CAST(o_orderdate AS DATE) AS ingest_date, CAST(l_orderkey AS VARCHAR) AS run_id,
         CASE WHEN count(*) FILTER (l_returnflag='R')>0 THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN count(*) FILTER (l_returnflag='R')>0 THEN 'failed' ELSE 'success' END||';'
           ||string_agg('table_'||l_linenumber||'='||CASE WHEN l_returnflag='R' THEN 'failed:error '||l_partkey ELSE 'success:' END, ','
             ORDER BY 'table_'||l_linenumber, l_returnflag<>'R', 'error '||l_partkey) AS items,
         string_agg('error '||l_partkey, ',' ORDER BY 'error '||l_partkey) FILTER (l_returnflag='R') AS errors,
         'test' AS env, min(l_shipdate) AS started_at, max(l_shipdate) AS finished_at,
         count(*) FILTER (l_returnflag<>'R') AS items_succeeded, count(*) FILTER (l_returnflag='R') AS items_failed
       FROM lineitem JOIN orders ON o_orderkey=l_orderkey GROUP BY 1,2,3""",
)
def a10(r: Roles) -> DataFrame:
    """Each order as a run, its lines as the items of the run."""
    failed = F.col("l_returnflag") == "R"
    results = r.raw("lineitem").join(r.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderdate").cast("date").alias("ingest_date"),
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.concat(F.lit("table_"), F.col("l_linenumber").cast("string")).alias("item"),
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.when(failed, F.concat(F.lit("error "), F.col("l_partkey").cast("string"))).alias("error"),
        F.lit("test").alias("env"),
        F.col("l_shipdate").alias("started_at"),
        F.col("l_shipdate").alias("finished_at"),
    )
    spelled = F.transform(
        "items", lambda i: F.concat(i["item"], F.lit("="), i["status"], F.lit(":"), F.coalesce(i["error"], F.lit("")))
    )
    return manifests.build_manifests(results).select(
        "source", "ingest_date", "run_id", "status",
        F.concat_ws(";", "status", F.array_join(spelled, ",")).alias("items"),
        F.nullif(F.array_join("error", ","), F.lit("")).alias("errors"),
        "env", "started_at", "finished_at", "items_succeeded", "items_failed",
    )


@query(
    "a11_idempotent_skip",
    f"""SELECT source, ingest_date, coalesce(status,'')='success' AS skip FROM (
         SELECT *, row_number() OVER (PARTITION BY source, ingest_date ORDER BY modified_at DESC, run_id DESC) AS rn
         FROM ({_RUNS})) WHERE rn=1""",
)
def a11(r: Roles) -> DataFrame:
    return manifests.should_skip(_runs(r))


_NEWEST = f"""SELECT source, ingest_date, status FROM (
         SELECT *, row_number() OVER (PARTITION BY source, ingest_date ORDER BY modified_at DESC, run_id DESC) AS rn
         FROM ({_RUNS})) WHERE rn=1"""


@query(
    "a12_latest_success",
    f"SELECT source, max(ingest_date) AS latest FROM ({_NEWEST}) WHERE status='success' GROUP BY source",
)
def a12_latest(r: Roles) -> DataFrame:
    return manifests.latest_success(_runs(r))


@query(
    "a12_next_business_date",
    f"""SELECT CAST(min(latest)+1 AS DATE) AS next_date FROM (
          SELECT source, max(ingest_date) AS latest FROM ({_NEWEST}) WHERE status='success' GROUP BY source)""",
)
def a12(r: Roles) -> DataFrame:
    return manifests.next_business_date(_runs(r))


@query(
    "a13_missing_partitions",
    """SELECT e.entity, d.day AS ingest_date
       FROM (VALUES ('click'),('error'),('purchase'),('signup'),('view')) e(entity),
            (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS day) d
       WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.event_type=e.entity AND CAST(x.ts AS DATE)=d.day)""",
)
def a13(r: Roles) -> DataFrame:
    present = r.raw("events").select(
        F.col("event_type").alias("entity"), F.col("ts").cast("date").alias("ingest_date")
    )
    names = ["click", "error", "purchase", "signup", "view"]
    return lake.missing_partitions(present, names, date(2024, 1, 1), date(2024, 12, 31))


@query(
    "a14_schema_union",
    """SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS balance FROM customer
       UNION ALL SELECT c_custkey, NULL, c_acctbal FROM customer""",
)
def a14(r: Roles) -> DataFrame:
    """Two writers with different columns, read as one table."""
    path = scratch_path(r.spark, "union")
    key = F.col("c_custkey").alias("id")
    r.raw("customer").select(key, F.col("c_name").alias("name")).write.parquet(f"{path}/part=a")
    r.raw("customer").select(key, F.col("c_acctbal").alias("balance")).write.parquet(f"{path}/part=b")
    return lake.read_merged(r.spark, path).select("id", "name", "balance")


@query(
    "a14_reconciled",
    """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS BIGINT) AS nation, c_acctbal AS balance, NULL AS note FROM customer
       UNION ALL SELECT c_custkey || 'x', c_nationkey, CAST(c_custkey % 100 AS DOUBLE), c_mktsegment FROM customer
       UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_nationkey, NULL, NULL FROM customer""",
)
def a14_reconciled(r: Roles) -> DataFrame:
    """Files whose columns are whole numbers, decimals or text, read as one."""
    path, key = scratch_path(r.spark, "types"), F.col("c_custkey")
    raw = r.raw("customer")
    raw.select(key.cast("long").alias("id"), F.col("c_nationkey").cast("int").alias("nation"), F.col("c_acctbal").alias("balance")).write.parquet(f"{path}/a")
    raw.select(
        F.concat(key.cast("string"), F.lit("x")).alias("id"), F.col("c_nationkey").cast("long").alias("nation"),
        (key % 100).cast("int").alias("balance"), F.col("c_mktsegment").alias("note"),
    ).write.parquet(f"{path}/b")
    raw.select(key.cast("int").alias("id"), F.col("c_nationkey").cast("short").alias("nation")).write.parquet(f"{path}/c")
    rows, _ = lake.read_reconciled(r.spark, [f"{path}/{n}" for n in "abc"])
    return rows


@query(
    "a15_seed_lookup",
    """SELECT e.ethnicity_group, i.deprivation_level, count(*) AS patients FROM b_patients p
       LEFT JOIN seed_ethnicity e ON e.ethnicity_code=p.ethnicity_ons
       LEFT JOIN seed_imd i ON i.imd_decile=p.imd_decile GROUP BY 1,2""",
)
def a15(r: Roles) -> DataFrame:
    ethnic = load_seed(r.spark, "ethnicity").withColumnRenamed("ethnicity_code", "ethnicity_ons")
    joined = r.patient_demographics.join(ethnic, "ethnicity_ons", "left").join(
        load_seed(r.spark, "imd"), "imd_decile", "left"
    )
    return joined.groupBy("ethnicity_group", "deprivation_level").agg(F.count(F.lit(1)).alias("patients"))


@query(
    "a16_gold_export",
    "SELECT *, DATE '2024-06-01' AS export_date FROM fct_urgent_care",
)
def a16(r: Roles) -> DataFrame:
    root = scratch_path(r.spark, "gold")
    exports.export_gold({"fct_urgent_care": r.urgent}, root, "2024-06-01")
    return exports.read_export(r.spark, root, "fct_urgent_care", every=True)


# The exported tables that follow the data, where they are in Spark, and a column to compare.
_EXPORTED = {
    "dim_patient": ("dim_patient", "patient_sk"), "dim_site": ("dim_site", "provider_code"),
    "dim_specialty": ("dim_specialty", "specialty_code"), "fct_wait_times": ("waits", "referral_id"),
    "fct_urgent_care": ("urgent", "uc_log_id"), "fct_utilisation": ("utilisation", "appointment_id"),
    "fct_inequality": ("inequality", "stratum"),
}
def _told(table: str, column: str) -> str:
    v = f"CAST({column} AS VARCHAR)"
    return f"SELECT '{table}' AS table_name, DATE '2024-06-01' AS export_date, count(*) AS n, min({v}) AS low, max({v}) AS high, count(DISTINCT {v}) AS names FROM {table}"


@query(
    "a16_whole_export",
    " UNION ALL ".join(_told(t, c) for t, (_, c) in _EXPORTED.items())
    + " UNION ALL SELECT 'dim_imd', DATE '2024-06-01', count(*), min(CAST(imd_decile AS VARCHAR)), max(CAST(imd_decile AS VARCHAR)), count(DISTINCT imd_decile) FROM seed_imd"
    " UNION ALL SELECT 'dim_ethnicity', DATE '2024-06-01', count(*), min(ethnicity_code), max(ethnicity_code), count(DISTINCT ethnicity_code) FROM seed_ethnicity"
    " UNION ALL SELECT 'dim_date', DATE '2024-06-01', count(*), min(strftime(d, '%Y%m%d')), max(strftime(d, '%Y%m%d')), count(DISTINCT d)"
    " FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)",
)
def a16_whole(r: Roles) -> DataFrame:
    """All ten tables exported and read back under their date."""
    root = scratch_path(r.spark, "gold")
    fixed = {"dim_date": calendar(r.spark), "dim_imd": gold.dim_imd(r.spark), "dim_ethnicity": gold.dim_ethnicity(r.spark)}
    keys = {t: c for t, (_, c) in _EXPORTED.items()} | {"dim_date": "date_sk", "dim_imd": "imd_decile", "dim_ethnicity": "ethnicity_code"}
    with settled_folder(r.spark):
        r.s_appointments = settle(r.s_appointments)
        for table, (name, _) in _EXPORTED.items():
            exports.export_gold({table: getattr(r, name)}, root, "2024-06-01")
            # Later tables are made from what is exported, not from its sources again.
            setattr(r, name, exports.read_export(r.spark, root, table, "2024-06-01"))
        exports.export_gold(fixed, root, "2024-06-01")
    parts = []
    for table, column in keys.items():
        value = F.col(column).cast("string")
        back = exports.read_export(r.spark, root, table, every=True)
        parts.append(
            back.groupBy("export_date").agg(
                F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.count_distinct(value).alias("names")
            ).select(F.lit(table).alias("table_name"), "export_date", "n", "low", "high", "names")
        )
    return reduce(DataFrame.unionByName, parts)


@query("a17_snapshot_discovery", "SELECT * REPLACE ('later' AS age_band) FROM dim_patient")
def a17(r: Roles) -> DataFrame:
    """Two exports that differ in a value, of which the newest is read."""
    root = scratch_path(r.spark, "gold")
    exports.export_gold({"dim_patient": r.dim_patient}, root, "2024-05-31")
    exports.export_gold({"dim_patient": r.dim_patient.withColumn("age_band", F.lit("later"))}, root, "2024-06-01")
    return exports.read_export(r.spark, root, "dim_patient")


@query(
    "a18_dq_sink",
    """SELECT 'labels' AS table_name, CASE WHEN (SELECT count(*) FROM labels)>=1 THEN 'PASSED' ELSE 'FAILED' END AS run_status,
         0 AS failure_count, DATE '2024-06-01' AS run_date
       UNION ALL SELECT 'lineitem', CASE WHEN max(n)>1 THEN 'FAILED' ELSE 'PASSED' END, CAST(max(n)>1 AS INT), DATE '2024-06-01'
         FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       UNION ALL SELECT 'orders', 'FAILED', -1, DATE '2024-06-01'""",
)
def a18(r: Roles) -> DataFrame:
    """Two runs of a day: the second replaces the first in the result table."""
    root = scratch_path(r.spark, "dq")
    tables = {n: r.raw(n) for n in ("labels", "lineitem", "orders")}
    suites = {
        "labels": [row_count(1), not_null("doc_id")],
        "lineitem": [row_count(1), unique("l_orderkey", "l_linenumber")],
        "orders": [not_null("no_such_column")],
    }
    for run_id in ("first", "second"):
        exports.write_runs(run_suites(r.spark, tables, suites, run_id, date(2024, 6, 1)), root)
    return exports.read_runs(r.spark, root).select("table_name", "run_status", "failure_count", "run_date")
