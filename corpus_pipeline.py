"""A training corpus from raw documents: reject, deduplicate, pseudonymise, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's input. All but the last return the columns of
``documents``, others included if the input has them.

Results: an empty table passes through empty; texts may be null or empty; of repeated rows
the near-duplicate stage keeps one; ids may be null; columns are carried in a struct where
a stage makes its own, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitlens.llm import mixing, neardup, packing, quality, surrogates
from waitlens.llm.common import Scratch, numbered, read, release, scratch_folder
from waitlens.llm.queries import SURROGATE_KEY, TOKENIZER


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line-chain classifier rejects go; the rest stays as it is."""
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.where(quality.score(F.col("row.text"), model) >= 0.5).select("row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays.

    Groups are components of links on five-word shingles at a similarity of 0.8.
    """
    scratch = Scratch(spark, "dedup-stage")
    rows = numbered(docs, scratch)
    found = neardup.near_duplicates(rows.select("name", "row.text"), id_col="name")
    ids = rows.select(F.col("name").alias("doc_id"), F.col("row.doc_id").cast("long").alias("id"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("doc_id").alias("name"))
    first = found.join(ids, "doc_id").groupBy("component_id").agg(F.min(order).alias("first"))
    kept = scratch.keep(first.select("first.name"))
    release(found)
    # The list grows with the documents; whole rows meet it in the same way at any size.
    return rows.hint("merge").join(kept, "name", "left_semi").select("row.*")


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by keyed surrogates; ``n_chars`` follows the text."""
    replaced = surrogates.replace_personal_data(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    scratch = Scratch(spark, "mix-stage")
    rows = numbered(docs, scratch)
    mixed = mixing.mix(rows.select("name", "row.doc_id", "row.text", "row.source"), carry="name")
    taken = scratch.keep(mixed.where("copies > 0").select("name", "copies"))
    release(mixed)
    repeated = F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")
    return rows.hint("merge").join(taken, "name").select(repeated).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their place in windows of 1024 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", classify),
    ("near-duplicates", deduplicate),
    ("personal data", pseudonymise),
    ("mixing", mix),
    ("packing", pack),
]

#: A chain model, components and a knapsack are not SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next.

    What a stage needed goes when its output is written, and the output when the next
    stage's is, so two of them at most are there at a time and one remains to be read.
    """
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch_folder(spark):
            kept = scratch.keep(stage(spark, docs, sf_dir))
        scratch.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
