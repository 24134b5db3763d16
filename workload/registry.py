"""The registered queries: name -> (Spark callable, SQL it must agree with or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.roles import Roles, with_tables

RUN_COLUMNS = ("_loaded_at", "rejected_at")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(roles) -> DataFrame`` under a name."""

    def register(f: Callable[[Roles], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(Roles(spark, sf_dir))
            return df.drop(*[c for c in RUN_COLUMNS if c in df.columns])

        REGISTRY[name] = Query(run, with_tables(sql) if sql else None)
        return f

    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places: sums of doubles depend on the order of addition."""
    return df.withColumns({c: F.round(F.col(c), 6) for c in columns})
