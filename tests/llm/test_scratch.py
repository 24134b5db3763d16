from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from tests.llm.frames import SF, documents, odd
from waitlens.llm import common, linededup, neardup, surrogates
from waitlens.session import shared_dir


def tables(spark):
    root = Path(shared_dir(spark).removeprefix("file:"))
    return {p.parent for p in root.rglob("_SUCCESS")}


def test_an_operator_leaves_its_result_only(spark):
    before = tables(spark)
    found = neardup.near_duplicates(documents(spark))
    assert len(tables(spark) - before) == 1
    assert found.count() == documents(spark).count()
    common.release(found)
    assert tables(spark) == before


def test_nothing_stays_after_the_block(spark):
    before = tables(spark)
    with common.scratch_folder(spark):
        surrogates.replace_personal_data(documents(spark), b"k").count()
        linededup.keep_lines(documents(spark)).count()
        assert tables(spark) - before
    assert tables(spark) == before


def test_nothing_stays_after_a_failure(spark):
    before = tables(spark)
    with pytest.raises(RuntimeError), common.Scratch(spark, "fails") as scratch:
        scratch.keep(spark.range(3))
        raise RuntimeError
    assert tables(spark) == before


def test_pipeline_leaves_one_table(spark):
    before = tables(spark)
    corpus_pipeline.run(spark, SF).count()
    assert len(tables(spark) - before) == 1


def test_numbers_name_each_row_once(spark, tmp_path):
    docs = documents(spark).unionByName(documents(spark))
    docs.repartition(5).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    for rows in (stored, odd(spark)):
        named = common.numbered(rows, common.Scratch(spark, "test"))
        assert named.select("name").distinct().count() == rows.count() == named.count()
    again = [{r.name: r.id for r in common.numbered(stored, common.Scratch(spark, "test")).select("name", "row.doc_id").toDF("name", "id").collect()} for _ in range(2)]
    assert again[0] == again[1]
