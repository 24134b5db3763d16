"""Reference lookups shipped with the package (tens of rows each)."""

from __future__ import annotations

import csv
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDER = Path(__file__).resolve().parent.parent / "seeds"
_WHOLE_NUMBERS = {"imd_decile", "imd_rank"}
SEEDS = ("ethnicity", "icd10", "imd", "lsoa_imd")


def seed_rows(name: str) -> list[dict]:
    if name not in SEEDS:
        raise ValueError(f"unknown seed: {name!r}")
    with open(_FOLDER / f"{name}.csv", encoding="utf-8", newline="") as f:
        lines = (line for line in f if not line.startswith("#"))
        return [
            {k: int(v) if k in _WHOLE_NUMBERS else v for k, v in row.items()}
            for row in csv.DictReader(lines)
        ]


def load_seed(spark: SparkSession, name: str) -> DataFrame:
    """A seed as a local relation: its size is known, so joins broadcast it by themselves."""
    rows = seed_rows(name)
    kinds = [pa.field(c, pa.int32() if c in _WHOLE_NUMBERS else pa.string()) for c in rows[0]]
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=pa.schema(kinds)))


def area_deprivation(spark: SparkSession) -> DataFrame:
    """Area code -> decile -> label: the two lookups of the patient model as one table."""
    areas = load_seed(spark, "lsoa_imd").select("lsoa_code", "imd_decile")
    return areas.join(load_seed(spark, "imd"), "imd_decile", "left").select(
        "lsoa_code", F.col("imd_decile"), "imd_label", "deprivation_level"
    )
