"""From raw documents to shards: identify, deduplicate, decontaminate, mix, shard.

Every stage takes the documents that the one before it kept and, but for the last,
returns documents with the same columns, whatever their names. Rows are told apart by
id and text, so that rows that repeat an id with another text are judged on their own.
Null ids are ids, null texts go in the first stage. An empty table stays empty, and
texts of any length are judged whole.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.llm import decontamination, language_id, mixing, sharding, simhash  # noqa: E402
from tallyloom.llm.common import small_side  # noqa: E402
from tallyloom.plans.storage import materialize  # noqa: E402

SHARDS = 24

# A text goes if its phrases take so many bits more than letters drawn by chance would:
# gibberish and scripts that were not learned, from about 40 to 150 letters on. Long numbers
# in hexadecimal in a short text add some 60 bits each.
REJECTED_BITS = 256.0


def _free_name(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as make it no column of the documents."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that tells them apart, and its name."""
    key = _free_name(docs, "_key")
    return docs.withColumn(key, F.struct(
        F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))), key


def _without(keyed: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return keyed.join(small_side(materialize(keys, "gone")), key, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and texts that
    every learned language explains worse than chance does, by ``REJECTED_BITS``. With no
    labelled document to learn from, only texts without a letter can be judged."""
    model = language_id.learn(docs)
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    keyed, key = _keyed(docs)
    rejected = (F.col("lang_pred") == language_id.UNDETERMINED) | (F.col("excess_bits") > REJECTED_BITS)
    gone = language_id.identify(keyed, model, key).where(rejected).select(
        F.col("doc_id").alias(key)).distinct()
    return _without(keyed, gone, key).drop(key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once."""
    keyed, key = _keyed(docs)
    marks = materialize(simhash.near_duplicates(keyed, key).select(
        F.col("doc_id").alias(key), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("stays")),
        "marks")
    kept = _without(keyed, marks.where("not stays").select(key).distinct(), key)
    repeated = small_side(materialize(
        marks.where("stays").groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key),
        "repeated"))
    once = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").unionByName(once).drop(key)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    keyed, key = _keyed(docs)
    found = decontamination.contained_items(
        keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_column=key)
    return _without(keyed, found.select(F.col("doc_id").alias(key)).distinct(), key).drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes its words, to the nearest whole time."""
    keyed, key = _keyed(docs)
    times, time = _free_name(docs, "_times"), _free_name(docs, "_time")
    taken = mixing.mix(keyed, id_column=key).groupBy(F.col("doc_id").alias(key)).agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias(times)).where(F.col(times) > 0)
    return keyed.join(small_side(materialize(taken, "times")), key).withColumn(
        time, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

# Automata and XXH64 have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
