"""Registered queries over the smallest tables: SQL where there is some, accuracy on held-out rows, the pipeline's stages."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import database, differences
from hirelens.llm.base import remainder
from hirelens.llm.oracles import ORACLES
from hirelens.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def db() -> duckdb.DuckDBPyConnection:
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SMALL), db, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_quality_rules", "op6_mixing"])
def test_native_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert [x for x in ("Python", "Pandas", "Arrow", "Cartesian", "BroadcastNestedLoop") if x in plan] == []


def test_language_id_is_accurate_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op10_language_id"](spark, MIDDLE).join(docs, "doc_id").filter("held_out and lang is not null")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_quality_ranks_held_out_rows(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = QUERIES["op2_quality_classifier"](spark, MIDDLE).join(labels, "doc_id").filter("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9


def test_language_model_beats_the_base_on_held_out_rows(spark):
    r = QUERIES["op1_language_model"](spark, MIDDLE).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_quality_rules_act_beyond_the_base(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op4_quality_rules"](spark, MIDDLE).filter("not kept and not base_failed").join(docs, "doc_id")
    assert found.count() > 0 and found.select("lang").distinct().count() > 1


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "mixing"]
    out = corpus_pipeline.run(spark, SMALL).collect()
    ids = {r.doc_id for r in docs.collect()}
    assert out and {r.doc_id for r in out} <= ids and len({r.doc_id for r in out}) == len(out)
    assert all(r.copies > 0 and "@mail" not in r.text for r in out)
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0


def test_remainder(spark):
    import zlib

    found = spark.createDataFrame([(i,) for i in (0, 7, -3, None)], "doc_id long").select("doc_id", remainder(F.col("doc_id"), 5).alias("r")).collect()
    assert [r.r for r in found] == [zlib.crc32(str(r.doc_id).encode()) % 5 if r.doc_id is not None else None for r in found]
