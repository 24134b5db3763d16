"""Session settings and the shared folders a job may use."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # The pads of a keyed hash are key material; keep literals of that shape out of
    # the UI, plan strings and event logs.
    "spark.sql.redaction.string.regex": r"(?i)X'[0-9a-f]{128}'|0x[0-9a-f]{128}|\[[0-9A-F]{2}( [0-9A-F]{2}){63}\]",
}


def build_session(app: str = "waitlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package relies on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def hide_key_material(spark: SparkSession) -> None:
    """Redact hash pads from plan text in a session built elsewhere."""
    name = "spark.sql.redaction.string.regex"
    if not spark.conf.get(name, None):
        spark.conf.set(name, SETTINGS[name])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, a session whose executors are threads of this process uses a folder
    next to its warehouse; any other must be told.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared")
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_FOLDER: ContextVar[str | None] = ContextVar("settled folder", default=None)


@contextmanager
def settled_folder(spark: SparkSession) -> Iterator[str]:
    """Tables settled inside the block live in one folder, which goes when the block ends.

    Threads started inside see it if they run in a copy of the context.
    """
    folder = scratch_path(spark, f"settled-{spark.sparkContext.applicationId}/run")
    token = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once: write it to the shared folder and go on from there.

    The written table cuts the lineage and survives lost executors like a checkpoint, but
    later steps read only the columns they need and joins know its size. The files live in
    the ``settled_folder`` around the call, or else under one folder per application, to be
    deleted when the application is done.
    """
    spark = df.sparkSession
    folder = _FOLDER.get()
    if folder is None:
        path = scratch_path(spark, f"settled-{spark.sparkContext.applicationId}/t")
    else:
        path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
