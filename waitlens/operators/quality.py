"""Data tests: declared checks, a fused runner, the promotion gate, freshness."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT_DDL = (
    "table_name string, check_name string, column_name string, severity string, "
    "evaluated bigint, failed bigint, passed boolean"
)
RUN_DDL = (
    "table_name string, run_date date, run_status string, failure_count int, "
    "run_id string, details string"
)


class QualityGateError(RuntimeError):
    """Promotion is blocked."""


@dataclass(frozen=True)
class Check:
    """One declared expectation; build it with the functions below."""

    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    low: object = None
    high: object = None
    where: str | None = None
    mostly: float = 1.0
    severity: str = "error"
    extra: dict = field(default_factory=dict, compare=False)

    @property
    def label(self) -> str:
        return ",".join(self.columns)


def not_null(column: str, mostly: float = 1.0, where: str | None = None, severity: str = "error") -> Check:
    """At least ``mostly`` of the rows hold a value."""
    return Check("not_null", (column,), mostly=mostly, where=where, severity=severity)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Check:
    """Every non-NULL value is one of ``values``."""
    return Check("accepted_values", (column,), values=tuple(values), severity=severity)


def between(column: str, low=None, high=None, where: str | None = None, severity: str = "error") -> Check:
    """Every non-NULL value lies in ``[low, high]``."""
    return Check("between", (column,), low=low, high=high, where=where, severity=severity)


def row_count(low: int | None = None, high: int | None = None, severity: str = "error") -> Check:
    """The table has between ``low`` and ``high`` rows."""
    return Check("row_count", low=low, high=high, severity=severity)


def unique(*columns: str, severity: str = "error") -> Check:
    """No value (or combination) occurs twice. A single NULL value is ignored."""
    return Check("unique" if len(columns) == 1 else "compound_unique", columns, severity=severity)


def distinct_in_set(column: str, values: Sequence, severity: str = "error") -> Check:
    """No distinct non-NULL value lies outside ``values``; counts the strays."""
    return Check("distinct_in_set", (column,), values=tuple(values), severity=severity)


def _scope(check: Check) -> Column:
    return F.expr(check.where) if check.where else F.lit(True)


def _scalar_counts(check: Check) -> tuple[Column, Column]:
    """(evaluated, failed) aggregates of a check that needs no grouping."""
    rows = F.count_if(_scope(check))
    if check.kind == "row_count":
        return rows, F.lit(0).cast("bigint")
    value = F.col(check.columns[0])
    if check.kind == "not_null":
        bad = value.isNull()
    elif check.kind == "accepted_values":
        bad = value.isNotNull() & ~value.isin(*check.values)
    else:
        bad = F.lit(False)
        if check.low is not None:
            bad = bad | (value < F.lit(check.low))
        if check.high is not None:
            bad = bad | (value > F.lit(check.high))
    return rows, F.count_if(_scope(check) & bad)


def _verdict(check: Check, evaluated: Column, failed: Column) -> Column:
    if check.kind == "row_count":
        ok = F.lit(True)
        if check.low is not None:
            ok = ok & (evaluated >= check.low)
        if check.high is not None:
            ok = ok & (evaluated <= check.high)
        return ok
    if check.mostly < 1.0:
        return (evaluated - failed) >= F.lit(check.mostly) * evaluated
    return failed == 0


def _grouped_counts(df: DataFrame, check: Check) -> DataFrame:
    """One row (evaluated, failed) for a check on groups of equal values."""
    scope = df.where(_scope(check))
    if check.kind == "distinct_in_set":
        value = F.col(check.columns[0])
        values = scope.where(value.isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        return values.agg(
            F.count(F.lit(1)).alias("_evaluated"),
            F.count_if(~value.isin(*check.values)).alias("_failed"),
        )
    if check.kind == "unique":
        scope = scope.where(F.col(check.columns[0]).isNotNull())
    sizes = scope.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_evaluated"),
        F.count_if(F.col("_n") > 1).alias("_failed"),
    )


_GROUPED = {"unique", "compound_unique", "distinct_in_set"}


def _row(table: str, check: Check, evaluated: Column, failed: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.label).alias("column_name"),
        F.lit(check.severity).alias("severity"),
        evaluated.cast("bigint").alias("evaluated"),
        failed.cast("bigint").alias("failed"),
        _verdict(check, evaluated, failed).alias("passed"),
    )


def plain_checks(checks: Sequence[Check]) -> list[Check]:
    """The checks that are plain counts over the rows."""
    return [c for c in checks if c.kind not in _GROUPED]


def grouped_checks(checks: Sequence[Check]) -> list[Check]:
    """The checks on groups of equal values, which need a pass of their own."""
    return [c for c in checks if c.kind in _GROUPED]


def checked_columns(checks: Sequence[Check]) -> set[str]:
    """The names a suite may read: its checks' columns and every word of their scopes."""
    words = [w for c in checks if c.where for w in re.findall(r"\w+", c.where)]
    return {*words, *[name for c in checks for name in c.columns]}


def _plain_aggregates(checks: Sequence[Check]) -> list[Column]:
    aggregates = []
    for i, check in enumerate(checks):
        evaluated, failed = _scalar_counts(check)
        aggregates += [evaluated.alias(f"_e{i}"), failed.alias(f"_f{i}")]
    return aggregates


def watched(df: DataFrame, table: str, checks: Sequence[Check]) -> tuple[DataFrame, Callable[[], DataFrame | None]]:
    """``df`` to be written, and what its plain checks found once that is done.

    The counts are taken in the pass of the write, so these checks read nothing again.
    """
    plain = plain_checks(checks)
    if not plain:
        return df, lambda: None
    seen = Observation(f"checks-{uuid.uuid4().hex}")

    def found() -> DataFrame:
        told = seen.get
        rows = [_row(table, c, F.lit(told[f"_e{i}"]), F.lit(told[f"_f{i}"])) for i, c in enumerate(plain)]
        return df.sparkSession.range(1).select(F.inline(F.array(*rows)))

    return df.observe(seen, *_plain_aggregates(plain)), found


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], found: DataFrame | None = None) -> DataFrame:
    """Result rows of all checks on one table.

    Every check that is a plain count is evaluated in one aggregation over one scan, unless
    ``found`` holds what ``watched`` saw. Uniqueness groups by its own key and adds one row.
    """
    parts: list[DataFrame] = []
    plain = plain_checks(checks)
    if found is not None:
        parts.append(found)
    elif plain:
        aggregates = _plain_aggregates(plain)
        rows = [
            _row(table, c, F.col(f"_e{i}"), F.col(f"_f{i}")) for i, c in enumerate(plain)
        ]
        parts.append(df.agg(*aggregates).select(F.inline(F.array(*rows))))
    for check in checks:
        if check.kind in _GROUPED:
            one = _grouped_counts(df, check)
            row = _row(table, check, F.col("_evaluated"), F.col("_failed"))
            parts.append(one.select(F.inline(F.array(row))))
    return reduce(DataFrame.unionByName, parts)


def summarise_runs(results: DataFrame, run_id: str, run_date: date) -> DataFrame:
    """One row per table: status and number of failed error-level checks."""
    broken = ~F.col("passed") & (F.col("severity") == "error")
    return results.groupBy("table_name").agg(
        F.lit(run_date).alias("run_date"),
        F.when(F.count_if(broken) > 0, "FAILED").otherwise("PASSED").alias("run_status"),
        F.count_if(broken).cast("int").alias("failure_count"),
        F.lit(run_id).alias("run_id"),
        F.to_json(
            F.sort_array(
                F.collect_list(
                    F.struct("check_name", "column_name", "severity", "evaluated", "failed", "passed")
                )
            )
        ).alias("details"),
    )


def run_suites(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    suites: Mapping[str, Sequence[Check]],
    run_id: str,
    run_date: date,
    found: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run every table's suite. A table that cannot be evaluated fails with count -1.

    ``found``: what ``watched`` saw of some tables while they were written.
    """
    rows = []
    for name, checks in suites.items():
        try:
            summary = summarise_runs(run_checks(tables[name], name, checks, (found or {}).get(name)), run_id, run_date)
            rows += [r.asDict() for r in summary.collect()]
        except (PySparkException, KeyError) as problem:
            rows.append(
                {
                    "table_name": name,
                    "run_date": run_date,
                    "run_status": "FAILED",
                    "failure_count": -1,
                    "run_id": run_id,
                    "details": f"{type(problem).__name__}: {problem}",
                }
            )
    return spark.createDataFrame(rows, RUN_DDL)


def gate_status(runs: DataFrame, run_date: date) -> DataFrame:
    """One row: failures, total_runs and whether promotion is blocked on ``run_date``."""
    today = runs.where(F.col("run_date") == F.lit(run_date))
    counts = today.agg(
        F.count_if(F.col("run_status") == "FAILED").alias("failures"),
        F.count(F.lit(1)).alias("total_runs"),
    )
    return counts.select(
        "*", ((F.col("failures") > 0) | (F.col("total_runs") == 0)).alias("blocked")
    )


def require_gate(runs: DataFrame, run_date: date) -> None:
    """Raise unless validation ran on ``run_date`` and nothing failed."""
    status = gate_status(runs, run_date).first()
    if status.total_runs == 0:
        raise QualityGateError(f"no validation run on {run_date}")
    if status.failures > 0:
        raise QualityGateError(f"{status.failures} table(s) failed validation on {run_date}")


def freshness(
    df: DataFrame, as_of: date, col: str = "ingest_date", warn_days: int = 2, error_days: int = 3
) -> DataFrame:
    """Age of the newest partition and its status; an empty source is an error."""
    age = F.datediff(F.lit(as_of), F.col("latest"))
    return df.agg(F.max(col).cast("date").alias("latest")).select(
        "latest",
        age.alias("age_days"),
        F.when(F.col("latest").isNull() | (age > error_days), "error")
        .when(age > warn_days, "warn")
        .otherwise("ok")
        .alias("status"),
    )
