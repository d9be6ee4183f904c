"""One query per operator over the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import (
    chat, collocations, decontamination, importance, language_id, language_model, metric_tree, mixing, personal_data, quality_classifier,
    quality_rules, simhash, substrings,
)
from hirelens.llm.base import remainder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is(doc_id: str, by: int, rest: int) -> Column:
    """Whether the hash of the id leaves a remainder; not so for a null id."""
    return F.coalesce(remainder(F.col(doc_id), by) == rest, F.lit(False))


def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _is("doc_id", 5, 1)
    scored = language_model.score_all(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _is("doc_id", 5, 0)
    scored = quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), texts=False).drop("kept")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = _is("doc_id", 4, 2)
    found = language_id.identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metric_tree.usable(table(spark, sf_dir, "embeddings"), "embedding").select(F.col("vec_id").alias("id"), "v")
    queries = points.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    return metric_tree.search(points, queries).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("row.doc_id", "n_features", "weight", "score", "rank")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_model, op2_quality_classifier, op3_decontamination, op4_quality_rules, op5_chat, op6_mixing,
    op7_personal_data, op8_simhash, op9_substrings, op10_language_id, op11_topk, op12_importance, op13_collocations)}
