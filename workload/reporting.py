"""Report queries, their chart shaping, and event monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.plans import reports
from waitlens.session import scratch_path
from waitlens.sources import exports
from waitlens.sources.keyed import KeyedTable, range_bucket
from waitlens.streaming import incremental, monitor, silence
from workload.registry import query, rounded
from workload.roles import Roles, latest_sql

_SOME_SITES = ("Supplier#000000004", "Supplier#000000007", "Supplier#000000013 (new)", "Supplier#000000021")
_SOME_SPECIALTIES = ("1-URGENT", "3-MEDIUM")
_SITES_SQL = ",".join(f"'{s}'" for s in _SOME_SITES)
_SPECIALTIES_SQL = ",".join(f"'{s}'" for s in _SOME_SPECIALTIES)
# Facts with the names of their site and specialty, as the definitions of the measures need them.
_WAIT_ROWS = """(SELECT wait_days, treatment_month, CAST(rtt_breach_flag AS INT) AS late,
    (SELECT provider_name FROM dim_site WHERE dim_site.site_sk = w.site_sk) AS site,
    (SELECT specialty_name FROM dim_specialty WHERE dim_specialty.specialty_sk = w.specialty_sk) AS specialty FROM fct_wait_times w)"""
_VISITS = """(SELECT *, CAST(four_hour_breach_flag AS INT) AS late, CAST(admitted_flag AS INT) AS stayed,
    (SELECT provider_name FROM dim_site WHERE dim_site.site_sk = v.site_sk) AS site FROM fct_urgent_care v)"""
_CHOSEN = f"site IN ({_SITES_SQL}) AND specialty IN ({_SPECIALTIES_SQL})"
_KPI_SQL = """SELECT round(sum(late) / count(late), 6) AS breach_rate_18wk, quantile_cont(wait_days, 0.5) AS median_wait_days,
    count(CASE WHEN wait_days >= 365 THEN 1 END) AS waiters_52wk FROM {} WHERE {}"""
_UC_RATES = """round(sum(late) / count(late), 6) AS breach_rate_4h,
    count(CASE WHEN twelve_hour_breach_flag THEN 1 END) AS breach_count_12h, round(sum(stayed) / count(stayed), 6) AS admission_rate"""
# A stage takes the mean time to its end less the mean time to its start.
_UC_STAGES = ", ".join(
    f"round({end} - {start}, 6) AS {name}"
    for name, start, end in (
        ("avg_triage", "0", "mean(arrival_to_triage_mins)"),
        ("avg_seen", "mean(arrival_to_triage_mins)", "mean(arrival_to_seen_mins)"),
        ("avg_discharge", "mean(arrival_to_seen_mins)", "mean(arrival_to_discharge_mins)"),
    )
)
_QUANTILES = "quantile_cont(wait_days, 0.5) AS p50_wait, round(quantile_cont(wait_days, 0.9), 6) AS p90_wait"
_RATES = ("breach_rate_4h", "admission_rate")
_STAGES = ("avg_triage", "avg_seen", "avg_discharge")


@query("g1_wait_kpis", _KPI_SQL.format(_WAIT_ROWS, "TRUE"))
def g1(r: Roles) -> DataFrame:
    return rounded(reports.wait_kpis(r.waits_model), "breach_rate_18wk")


@query("g1_wait_kpis_filtered", _KPI_SQL.format(_WAIT_ROWS, _CHOSEN))
def g1_filtered(r: Roles) -> DataFrame:
    return rounded(reports.wait_kpis(r.waits_model, _SOME_SITES, _SOME_SPECIALTIES), "breach_rate_18wk")


@query(
    "g2_wait_by_provider",
    f"SELECT site AS provider_name, {_QUANTILES} FROM {_WAIT_ROWS} WHERE site IS NOT NULL GROUP BY site",
)
def g2(r: Roles) -> DataFrame:
    return rounded(reports.wait_by_provider(r.waits_model), "p90_wait")


_TREND = f"""SELECT strftime(treatment_month, '%Y-%m') AS treatment_month, {_QUANTILES} FROM {_WAIT_ROWS} GROUP BY 1"""


@query("g3_wait_trend", _TREND)
def g3(r: Roles) -> DataFrame:
    return rounded(reports.wait_trend(r.waits_model), "p90_wait")


def _exported(r: Roles, cells: bool) -> reports.Gold:
    """The wait tables of an export, read back; ``cells``: counts stored in place of facts."""
    root = scratch_path(r.spark, "gold")
    tables = {"fct_wait_times": r.waits, "dim_site": r.dim_site, "dim_specialty": r.dim_specialty}
    exports.export_gold(tables, root, "2024-06-01")
    read = {t: exports.read_export(r.spark, root, t) for t in tables}
    waits = read["fct_wait_times"]
    if cells:
        reports.wait_cells(waits).write.parquet(f"{root}/cells")
        waits = r.spark.read.parquet(f"{root}/cells")
    return reports.Gold(waits=waits, sites=read["dim_site"], specialties=read["dim_specialty"])


@query("g1_on_export", _KPI_SQL.format(_WAIT_ROWS, _CHOSEN))
def g1_export(r: Roles) -> DataFrame:
    return rounded(reports.wait_kpis(_exported(r, False), _SOME_SITES, _SOME_SPECIALTIES), "breach_rate_18wk")


@query("g1_from_cells", _KPI_SQL.format(_WAIT_ROWS, _CHOSEN))
def g1_cells(r: Roles) -> DataFrame:
    return rounded(reports.wait_kpis(_exported(r, True), _SOME_SITES, _SOME_SPECIALTIES), "breach_rate_18wk")


@query(
    "g2_from_cells",
    f"SELECT site AS provider_name, {_QUANTILES} FROM {_WAIT_ROWS} WHERE site IS NOT NULL GROUP BY site",
)
def g2_cells(r: Roles) -> DataFrame:
    return rounded(reports.wait_by_provider(_exported(r, True)), "p90_wait")


@query("g3_from_cells", _TREND)
def g3_cells(r: Roles) -> DataFrame:
    return rounded(reports.wait_trend(_exported(r, True)), "p90_wait")


@query(
    "g4_month_bounds",
    """SELECT strftime(min(treatment_month),'%Y-%m') AS min_month, strftime(max(treatment_month),'%Y-%m') AS max_month FROM fct_wait_times""",
)
def g4(r: Roles) -> DataFrame:
    return reports.month_bounds(r.waits_model)


@query(
    "g5_inequality_kpis",
    """SELECT round((SELECT sii_value FROM fct_inequality WHERE metric_name='dna_rate' AND stratifier='imd_decile' ORDER BY period DESC LIMIT 1),6) AS sii,
         round((SELECT max(metric_value)-min(metric_value) FROM fct_inequality WHERE metric_name='dna_rate' AND stratifier='imd_decile' AND stratum IN ('1','10')),6) AS imd_gap,
         (SELECT count(*) FROM fct_inequality WHERE metric_name='dna_rate' AND population_count IS NULL) AS suppressed_count""",
)
def g5(r: Roles) -> DataFrame:
    return rounded(reports.inequality_kpis(r.inequality_model, "dna_rate"), "sii", "imd_gap")


@query(
    "g5_inequality_kpis_waits",
    """SELECT round((SELECT sii_value FROM fct_inequality WHERE metric_name='wait_time_median' AND stratifier='imd_decile' ORDER BY period DESC NULLS LAST LIMIT 1),6) AS sii,
         (SELECT max(metric_value)-min(metric_value) FROM fct_inequality WHERE metric_name='wait_time_median' AND stratifier='imd_decile' AND stratum IN ('1','10')) AS imd_gap,
         (SELECT count(*) FROM fct_inequality WHERE metric_name='wait_time_median' AND population_count IS NULL) AS suppressed_count""",
)
def g5_waits(r: Roles) -> DataFrame:
    return rounded(reports.inequality_kpis(r.inequality_model), "sii")


_STRATA_SQL = """SELECT metric_name, period, stratum, population_count, round(metric_value,6) AS metric_value,
    round(sii_value,6) AS sii_value, round(rii_value,6) AS rii_value FROM fct_inequality WHERE stratifier='imd_decile'"""


@query("g6_strata", _STRATA_SQL)
def g6(r: Roles) -> DataFrame:
    return rounded(
        reports.strata_of(r.inequality_model, "imd_decile"), "metric_value", "sii_value", "rii_value"
    )


@query("g7_urgent_kpis", f"SELECT {_UC_RATES} FROM {_VISITS}")
def g7(r: Roles) -> DataFrame:
    return rounded(reports.urgent_kpis(r.urgent_model), *_RATES)


@query("g7_urgent_kpis_filtered", f"SELECT {_UC_RATES} FROM {_VISITS} WHERE site IN ({_SITES_SQL})")
def g7_filtered(r: Roles) -> DataFrame:
    return rounded(reports.urgent_kpis(r.urgent_model, _SOME_SITES), *_RATES)


@query(
    "g8_stage_times",
    f"SELECT site AS provider_name, {_UC_STAGES} FROM {_VISITS} WHERE site IS NOT NULL GROUP BY site",
)
def g8(r: Roles) -> DataFrame:
    return rounded(reports.stage_times(r.urgent_model), *_STAGES)


@query(
    "g9_breach_trend",
    f"""SELECT arrival_month, round(sum(late) / count(late), 6) AS breach_rate_4h FROM {_VISITS} GROUP BY arrival_month""",
)
def g9(r: Roles) -> DataFrame:
    return rounded(reports.breach_trend(r.urgent_model), "breach_rate_4h")


_HOURS = f"""SELECT strftime(arrival_datetime, '%A') AS day_of_week, CAST(hour(arrival_datetime) AS INT) AS hour_of_day,
    count(*) AS attendance_count FROM {_VISITS} GROUP BY ALL"""


@query("g10_busiest_hours", _HOURS)
def g10(r: Roles) -> DataFrame:
    return reports.busiest_hours(r.urgent_model)


@query(
    "g11_urgent_equity",
    f"""SELECT CAST(imd_decile AS INT) AS stratum, {_UC_RATES}, {_UC_STAGES}, count(*) AS attendance_count
        FROM {_VISITS} JOIN dim_patient USING (patient_sk) WHERE is_current GROUP BY imd_decile""",
)
def g11(r: Roles) -> DataFrame:
    return rounded(reports.urgent_equity(r.urgent_model, "IMD Decile"), *_RATES, *_STAGES)


@query(
    "g11_urgent_equity_ethnicity",
    f"""SELECT ethnicity_ons AS stratum, {_UC_RATES}, {_UC_STAGES}, count(*) AS attendance_count
        FROM {_VISITS} JOIN dim_patient USING (patient_sk) WHERE is_current AND site IN ({_SITES_SQL}) GROUP BY ethnicity_ons""",
)
def g11_ethnicity(r: Roles) -> DataFrame:
    return rounded(reports.urgent_equity(r.urgent_model, "Ethnicity", _SOME_SITES), *_RATES, *_STAGES)


@query(
    "g12_provider_options",
    "SELECT DISTINCT provider_name FROM dim_site WHERE site_sk IN (SELECT site_sk FROM fct_wait_times)",
)
def g12(r: Roles) -> DataFrame:
    return reports.provider_options(r.waits_model)


@query("g12_site_options", "SELECT DISTINCT provider_name FROM dim_site")
def g12_sites(r: Roles) -> DataFrame:
    return reports.site_options(r.urgent_model)


@query("g12_specialty_options", "SELECT DISTINCT specialty_name FROM dim_specialty")
def g12_specialties(r: Roles) -> DataFrame:
    return reports.specialty_options(reports.Gold(specialties=r.dim_specialty))


@query(
    "g12_month_options",
    "SELECT DISTINCT strftime(treatment_month,'%Y-%m') AS month FROM fct_wait_times WHERE treatment_month IS NOT NULL",
)
def g12_months(r: Roles) -> DataFrame:
    return reports.month_options(r.waits_model)


@query("g13_month_range", f"SELECT * FROM ({_TREND}) WHERE treatment_month BETWEEN '1996-03' AND '1998-09'")
def g13(r: Roles) -> DataFrame:
    return rounded(reports.month_range(reports.wait_trend(r.waits_model), "1996-03", "1998-09"), "p90_wait")


_MEAN_SQL = """SELECT metric_name, stratum, avg(metric_value) AS metric_value FROM fct_inequality WHERE stratifier='imd_decile' GROUP BY 1,2"""


def _means(r: Roles) -> DataFrame:
    return reports.mean_over_periods(
        reports.strata_of(r.inequality_model, "imd_decile"), "metric_name", "stratum"
    )


@query("g14_mean_over_periods", f"SELECT metric_name, stratum, round(metric_value,6) AS metric_value FROM ({_MEAN_SQL})")
def g14(r: Roles) -> DataFrame:
    return rounded(_means(r), "metric_value")


@query(
    "g15_scaled",
    f"""SELECT metric_name, stratum, round(CASE WHEN min(metric_value) OVER w = max(metric_value) OVER w THEN 0.5
          ELSE (metric_value-min(metric_value) OVER w)/(max(metric_value) OVER w-min(metric_value) OVER w) END,6) AS normalized
        FROM ({_MEAN_SQL}) WHERE metric_value IS NOT NULL WINDOW w AS (PARTITION BY metric_name)""",
)
def g15(r: Roles) -> DataFrame:
    return rounded(reports.scaled_within(_means(r)), "normalized").drop("metric_value")


@query(
    "g16_deviation",
    f"""SELECT metric_name, stratum, round(metric_value-avg(metric_value) OVER (PARTITION BY metric_name),6) AS deviation FROM ({_MEAN_SQL})
        WHERE metric_value IS NOT NULL""",
)
def g16(r: Roles) -> DataFrame:
    found = reports.deviation_from_mean(_means(r), within="metric_name")
    return rounded(found, "deviation").select("metric_name", "stratum", "deviation")


@query(
    "g17_heat_matrix",
    "SELECT day_of_week, CAST(CASE day_of_week WHEN 'Monday' THEN 1 WHEN 'Tuesday' THEN 2 WHEN 'Wednesday' THEN 3 WHEN 'Thursday' THEN 4 "
    "WHEN 'Friday' THEN 5 WHEN 'Saturday' THEN 6 ELSE 7 END AS INT) AS day_order, "
    + ", ".join(
        f"CAST(sum(attendance_count) FILTER (hour_of_day={h}) AS BIGINT) AS \"{h:02d}:00\"" for h in range(24)
    )
    + f" FROM ({_HOURS}) GROUP BY day_of_week",
)
def g17(r: Roles) -> DataFrame:
    return reports.heat_matrix(reports.busiest_hours(r.urgent_model))


@query(
    "g18_suppression_marks",
    """SELECT metric_name, period, stratum, metric_value IS NULL AS suppressed, round(coalesce(metric_value,0),6) AS bar_value
       FROM fct_inequality WHERE stratifier='ethnicity_ons'""",
)
def g18(r: Roles) -> DataFrame:
    marked = reports.suppression_marks(reports.strata_of(r.inequality_model, "ethnicity_ons"))
    return rounded(marked, "bar_value").select("metric_name", "period", "stratum", "suppressed", "bar_value")


@query(
    "g19_percent",
    f"""SELECT round(coalesce(breach_rate_4h,0)*100,4) AS breach_rate_4h, breach_count_12h, round(coalesce(admission_rate,0)*100,4) AS admission_rate
        FROM (SELECT {_UC_RATES} FROM {_VISITS})""",
)
def g19(r: Roles) -> DataFrame:
    scaled = reports.as_percent(rounded(reports.urgent_kpis(r.urgent_model), *_RATES), *_RATES)
    return scaled.withColumns({c: F.round(F.col(c), 4) for c in _RATES})


_LATEST_LINES = latest_sql("SELECT * FROM lineitem", "l_orderkey, l_linenumber", "l_shipdate, l_partkey, l_suppkey")
_LINE_KEYS, _LINE_ORDER, _LINE_TIES = ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey"]


def _line_table(r: Roles, base: str) -> KeyedTable:
    # Some fifty buckets, whatever the size of the test table.
    width = max(1, r.raw("lineitem").agg(F.max("l_orderkey")).first()[0] // 50)
    return KeyedTable(r.spark, f"{base}/table", _LINE_KEYS, range_bucket("l_orderkey", width))


def _streamed(r: Roles, newest_first: bool) -> DataFrame:
    """Lines delivered in three drops by date, each loaded by a stream into one table."""
    base = scratch_path(r.spark, "stream")
    rows = r.raw("lineitem")
    table = _line_table(r, base)
    cuts = [F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in ("1995-01-01", "1998-06-01")]
    at = F.col("l_shipdate")
    drops = [rows.where(at < cuts[0]), rows.where((at >= cuts[0]) & (at < cuts[1])), rows.where((at >= cuts[1]) | at.isNull())]
    for drop in reversed(drops) if newest_first else drops:
        drop.write.mode("append").parquet(f"{base}/bronze")
        new = incremental.read_new_files(r.spark, f"{base}/bronze", rows.schema)
        incremental.upsert_stream(new, table, _LINE_KEYS, _LINE_ORDER, _LINE_TIES, f"{base}/checkpoint").awaitTermination()
    return table.read()


@query("h1_incremental_upsert", _LATEST_LINES)
def h1(r: Roles) -> DataFrame:
    return _streamed(r, newest_first=False)


@query("h1_newest_first", _LATEST_LINES)
def h1_newest_first(r: Roles) -> DataFrame:
    """An older row that comes later does not replace a newer one."""
    return _streamed(r, newest_first=True)


@query("h1_replayed_batch", _LATEST_LINES)
def h1_replayed(r: Roles) -> DataFrame:
    """A batch that comes again under its number, even changed, is not merged again."""
    rows = r.raw("lineitem")
    table = _line_table(r, scratch_path(r.spark, "replay"))
    merge = lambda df, name: table.merge(df, _LINE_KEYS, _LINE_ORDER, _LINE_TIES, batch_id=name)
    odd = F.col("l_orderkey") % 2 == 1
    merge(rows.where(odd), "first")
    merge(rows.where(~odd), "second")
    if merge(rows.where(odd).withColumn("l_shipdate", F.lit("2100-01-01").cast("timestamp_ntz")), "first"):
        raise AssertionError("a replayed batch was merged")
    return table.read()


@query(
    "h2_event_windows",
    """SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
         event_type AS event, count(*) AS event_count FROM events GROUP BY ALL""",
)
def h2(r: Roles) -> DataFrame:
    return monitor.event_windows(r.raw("events"))


@query(
    "h3_threshold_alarm",
    """SELECT window_start, event, event_count, 'ALARM' AS state FROM (
         SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type AS event, count(*) AS event_count FROM events GROUP BY ALL)
       WHERE event IN ('error','purchase') AND event_count>=4""",
)
def h3(r: Roles) -> DataFrame:
    return monitor.threshold_alarm(
        monitor.event_windows(r.raw("events"), width="1 hour"), ["error", "purchase"], 4
    )


@query(
    "h4_staleness",
    """WITH e AS (SELECT event_type AS event, date_trunc('hour', ts) AS hour FROM events),
         span AS (SELECT min(hour) AS a, max(hour) AS b FROM e),
         grid AS (SELECT event, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM (SELECT DISTINCT event FROM e), span),
         n AS (SELECT g.event, g.hour, count(e.event) AS event_count FROM grid g LEFT JOIN e ON e.event=g.event AND e.hour=g.hour GROUP BY ALL)
       SELECT event, CAST(hour AS TIMESTAMP) AS hour, event_count,
         sum(CASE WHEN event_count>=2 THEN 1 ELSE 0 END) OVER w = 0 AND count(*) OVER w = 3 AS stale
       FROM n WINDOW w AS (PARTITION BY event ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def h4(r: Roles) -> DataFrame:
    return monitor.staleness(r.raw("events"), periods=3, threshold=2)


@query(
    "h4_streamed_staleness",
    """WITH e AS (SELECT event_type AS event, date_trunc('hour', ts) AS hour FROM events),
         span AS (SELECT min(hour) AS a, (SELECT date_trunc('hour', max(ts)) FROM events) - INTERVAL 1 HOUR AS b FROM e),
         grid AS (SELECT event, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM (SELECT DISTINCT event FROM e), span),
         n AS (SELECT g.event, g.hour, count(e.event) AS event_count FROM grid g LEFT JOIN e ON e.event=g.event AND e.hour=g.hour GROUP BY ALL)
       SELECT event, CAST(hour AS TIMESTAMP) AS hour, event_count,
         sum(CASE WHEN event_count>=2 THEN 1 ELSE 0 END) OVER w = 0 AND count(*) OVER w = 3 AS stale
       FROM n WINDOW w AS (PARTITION BY event ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def h4_streamed(r: Roles) -> DataFrame:
    """The same from a stream in three drops: timers close the hours, all but the last."""
    base = scratch_path(r.spark, "silence")
    rows = r.raw("events").select("ts", "event_type")
    ends = rows.agg(F.min("ts").alias("a"), F.expr("percentile_approx(ts, array(0.4D, 0.7D))").alias("cuts")).first()
    low, high = ends.cuts
    drops = [rows.where(F.col("ts") < low), rows.where((F.col("ts") >= low) & (F.col("ts") < high)), rows.where(F.col("ts") >= high)]
    for drop in drops:
        drop.write.mode("append").parquet(f"{base}/in")
        stream = r.spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        closed = silence.watch_silence(stream, periods=3, threshold=2, since=ends.a, forget_after=None)
        found = silence.drain(closed, f"{base}/out", f"{base}/checkpoint")
    return found
