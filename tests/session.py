"""The local session the tests and the bench share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from waitlens.session import build_session


def local_session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "waitlens-local",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
