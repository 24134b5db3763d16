"""Listing folders through the cluster's own file system client."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _open(spark, path)
    return fs.exists(target)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``; none when it does not exist."""
    target, fs = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path``; none when it does not exist."""
    target, fs = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _open(spark, path)
    fs.delete(target, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless it is there: whole or not at all. False if it was there."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    source, fs = _open(spark, draft)
    target, _ = _open(spark, path)
    stream = fs.create(source, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        # This rename refuses a target that exists, which the file system's own may not.
        context.rename(source, target, options)
        return True
    except Py4JJavaError:
        if not fs.exists(target):
            raise
        fs.delete(source, False)
        return False


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=value`` folders, from the listing alone: no file is opened."""
    prefix = f"{column}="
    return [n[len(prefix):] for n in subfolders(spark, path) if n.startswith(prefix)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as a table layout."""
    target, fs = _open(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file; nothing after it is read but what is buffered."""
    target, fs = _open(spark, path)
    stream = fs.open(target)
    jvm = spark._jvm
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under another name first: it appears complete or not at all."""
    target, fs = _open(spark, path)
    draft, _ = _open(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not fs.rename(draft, target):
        raise OSError(f"could not commit {path}")
