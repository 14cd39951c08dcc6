"""From raw documents to a training mix, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speechlake.llm import decontaminate, language, lines, mixing, simhash
from speechlake.operators.checkpoints import discard, settle


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a model of the labelled ones recognises; the others go."""
    return language.keep_recognised(docs, language.train(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of multi-line passages go, and documents of which nothing else is left."""
    cut = lines.dedup_lines(docs, counts=True)
    nothing_left = (F.col("n_removed") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"\S")
    return cut.where(~nothing_left).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go, or the whole of an item of five to nine words."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least=5)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with how many: ``size, source_size, target, taken`` are added."""
    mix = mixing.mix_sources(docs).where(F.col("taken") > 0).select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__source"), F.col("tie").alias("__tie"),
        "size", "source_size", "target", "taken").dropDuplicates(["__doc", "__source", "__tie"])
    held = docs.select("doc_id", "text", "lang", "source", "n_chars")
    same = (held["doc_id"].eqNullSafe(mix["__doc"]) & held["source"].eqNullSafe(mix["__source"])
            & (F.xxhash64(held["text"]) == mix["__tie"]))
    return held.join(mix, same).drop("__doc", "__source", "__tie")


STAGES = [
    ("language", recognised), ("lines", without_repeated_lines), ("near copies", one_of_each_group),
    ("benchmark", without_benchmark), ("mix", mixed),
]
ORACLE_SQL = None  # fitted language scores and hashes are beyond SQL; the tests hold near copies against brute force and the stages' promises against rows


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each reads the table that the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        before, docs = docs, settle(stage(spark, docs, sf_dir))
        discard(before)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
