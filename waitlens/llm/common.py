"""Helpers the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.session import scratch_path

U64 = np.uint64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_BLOCK: ContextVar[str | None] = ContextVar("folder of the block's tables", default=None)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[None]:
    """All tables of operators run inside the block lie in one folder, deleted at its end."""
    folder = scratch_path(spark, f"block-{spark.sparkContext.applicationId}")
    token = _BLOCK.set(folder)
    try:
        yield
    finally:
        _BLOCK.reset(token)
        _delete(spark, folder)


class Scratch:
    """Intermediate tables of one operator run, under the folder all executors share.

    ``keep`` writes a frame and reads it back: lineage ends there, so a lost executor
    repeats only later work. ``drop`` deletes tables that nothing lazy reads any more, and
    ``finish`` keeps a result and deletes everything else, so an operator leaves one narrow
    table behind; ``release`` deletes that when its reader is done. When the block of a
    ``with`` fails, all tables go.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        block = _BLOCK.get()
        self.root = f"{block}/{label}-{uuid.uuid4().hex}" if block else scratch_path(spark, f"{label}-{spark.sparkContext.applicationId}")
        self._made = 0
        self._there: set[str] = set()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, problem, *_) -> None:
        if problem is not None:
            self.clear()

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/t{self._made}"
        self._made += 1
        self._there.add(path)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._scratch_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        release(*frames)
        self._there -= {getattr(df, "_scratch_path", None) for df in frames}

    def clear(self, *but: DataFrame) -> None:
        """Delete all tables but some."""
        stay = {df._scratch_path for df in but}
        for path in self._there - stay:
            _delete(self.spark, path)
        self._there &= stay
        if not stay:
            _delete(self.spark, self.root)

    def finish(self, df: DataFrame) -> DataFrame:
        kept = self.keep(df)
        self.clear(kept)
        return kept


def release(*frames: DataFrame) -> None:
    """Delete tables written by ``keep`` or ``finish``; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path is not None:
            _delete(df.sparkSession, path)
            folder = path.rpartition("/")[0]
            if not _names(df.sparkSession, folder):
                _delete(df.sparkSession, folder)


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    system, target = _folder(spark, path)
    system.delete(target, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    system, target = _folder(spark, path)
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def numbered(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(name, row): every row as a struct, under a number of its own that stays the same.

    Ids may repeat or be null; the number never does. A row of a file is named by file and
    place, so nothing is written; of the files only the list reaches the driver, which has
    made it anyway. Rows that come from elsewhere are written with their numbers.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    try:
        placed = docs.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"), row)
    except AnalysisException:
        return scratch.keep(docs.select(F.monotonically_increasing_id().alias("name"), row))
    files = pa.array(sorted(r[0] for r in placed.select("_file").distinct().collect()), pa.string())

    def number(names: pa.Array) -> pa.Array:
        return pc.index_in(names, files).cast(pa.int64())

    file = F.arrow_udf(number, "long")("_file")
    return placed.select(F.call_function("shiftleft", file, F.lit(40)).bitwiseOR(F.col("_at")).alias("name"), "row")


def width(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session has."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (xor-shift and multiply, twice)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(32))
        x = x * U64(0x9E3779B97F4A7C15)
        x = x ^ (x >> U64(29))
        x = x * U64(0xD6E8FEB86659FD93)
        return x ^ (x >> U64(32))


class WordTable(dict):
    """What a function makes of a word, kept for the words seen lately.

    Two generations bound the memory: when the young one is full it becomes the old one,
    and words found there move back. Forgetting a word only means computing it again.
    """

    def __init__(self, make: Callable[[object], object], bound: int = 300_000):
        super().__init__()
        self.make = make
        self.bound = bound
        self.old: dict = {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        self.put(word, value)
        return value

    def put(self, word, value) -> None:
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[word] = value

    def lacks(self, words: set) -> list:
        return [w for w in words if w not in self and w not in self.old]


def slices(batch: pa.RecordBatch, column: int, budget: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch holding about ``budget`` bytes of the text column each."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + budget, side="right")))
        yield start, stop
        start = stop


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


