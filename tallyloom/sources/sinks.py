"""Result sinks, which replace what was there, and reading back what they wrote."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators import ordinals
from tallyloom.plans.storage import materialize

SHARDS = 64

# Rows (of a term and block) in a bucket of a keyed table.
BUCKET_ROWS = 1 << 16

# Tasks that gather the postings of a block of ordinals.
BLOCK_TASKS = 8

_MANIFEST = "version bigint, folder string, inputs array<string>"


def write_tsv(df: DataFrame, path: str) -> None:
    """``key<TAB>value`` part files."""
    df.write.mode("overwrite").csv(path, sep="\t", quote="", escape="", emptyValue="")


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typed rows of files from ``write_tsv``. An empty field is NULL."""
    return spark.read.schema(schema).csv(path, sep="\t", quote="", escape="", emptyValue="")


def write_ordered_tsv(df: DataFrame, path: str, *order: str | Column) -> None:
    """Part files that are sorted when read in the order of their names."""
    write_tsv(df.orderBy(*order), path)


def write_rows(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def replace_rows(df: DataFrame, path: str, inputs: Iterable[str] = ()) -> None:
    """Write the rows as a new version and switch to it once it is whole.

    The rows go to a folder of their own. The switch is one small file in the manifest,
    which appears as a whole; until then, and if the write fails, readers see the version
    before. ``inputs`` names what the rows were made from. Of writers that race, one wins.
    """
    before = current_version(df.sparkSession, path)
    version = before.version + 1 if before else 1
    folder = f"rows-{version}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    manifest = df.sparkSession.createDataFrame([(version, folder, list(inputs))], _MANIFEST)
    manifest.coalesce(1).write.mode("append").json(f"{path}/manifest")


def current_version(spark: SparkSession, path: str) -> Row | None:
    """(version, folder, inputs) of the newest whole version; None before the first."""
    try:
        found = spark.read.schema(_MANIFEST).json(f"{path}/manifest")
    except AnalysisException:
        return None
    return found.orderBy(F.col("version").desc(), F.col("folder").desc()).first()


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest whole version."""
    current = current_version(spark, path)
    if current is None:
        raise FileNotFoundError(f"no version of rows in {path}")
    return spark.read.parquet(f"{path}/{current.folder}")


def shard_of(term: Column, shards: Column) -> Column:
    return F.pmod(F.hash(term), shards)


def _laid_out(index: DataFrame, shards: int) -> DataFrame:
    """Partitions by shard and block, sorted by term; a heavy term spans several of them.

    They are dealt out by hash: ranges would have to be sampled, for which the index would
    be made twice. The number of shards is stored with the rows, so that a lookup need not
    know it.
    """
    return (
        index.withColumn("shards", F.lit(shards))
        .withColumn("shard", shard_of(F.col("term"), F.col("shards")))
        .repartition("shard", "block")
        .sortWithinPartitions("shard", "term", "block")
    )


def write_index(index: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Store an index (term, block, ...) so that a term is found by pruning.

    The shard picks the directory and, as rows are sorted by term, the row group
    statistics pick the row groups.
    """
    _laid_out(index, shards).write.mode("overwrite").partitionBy("shards", "shard").parquet(path)


def write_postings(frequencies: DataFrame, path: str, documents: int,
                   block_docs: int = ordinals.BLOCK_DOCS, shards: int = SHARDS) -> None:
    """Store the ordinal index of (term, doc_id, tf, ordinal) rows, as ``write_index`` would.

    Postings are shuffled once, to the task of their shard and block of ordinals, which
    gathers, sorts and writes the terms of it. ``documents`` tells how many ordinals
    there are, so that tasks grow in number and not in size.
    """
    cores = frequencies.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-documents // block_docs) * BLOCK_TASKS)
    key = ["shards", "shard", "block"]
    placed = (
        frequencies.withColumn("block", ordinals.block_of("ordinal", block_docs))
        .withColumn("shards", F.lit(shards))
        .withColumn("shard", shard_of(F.col("term"), F.col("shards")))
        .repartition(tasks, "shard", "block")
    )
    index = placed.groupBy(*key, "term").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "doc_id", "tf"))).alias("postings"))
    index.select("term", "block", "postings", "shards", "shard").sortWithinPartitions(
        "shard", "term", "block").write.mode("overwrite").partitionBy("shards", "shard").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_index_table(index: DataFrame, table: str, shards: int = SHARDS) -> None:
    """The same layout as a catalog table, dropped and created anew."""
    _laid_out(index, shards).write.mode("overwrite").partitionBy("shards", "shard").format(
        "parquet"
    ).saveAsTable(table)


def stored_terms(index: DataFrame, terms: list[str]) -> DataFrame:
    """The rows of the terms, read from their shards only, in one scan."""
    if not terms:
        return index.drop("shards").limit(0)
    homes = F.col("shard").isin(*(shard_of(F.lit(term), F.col("shards")) for term in terms))
    return index.where(homes).where(F.col("term").isin(terms)).drop("shards")


def save_keyed_table(index: DataFrame, table: str, folder: str | None = None,
                     buckets: int | None = None) -> None:
    """Store an index (term, block, ...) as the catalog tables ``table_rows`` and ``table_blocks``.

    Rows are bucketed by the whole key, so the blocks of a frequent term lie in many
    buckets. ``table_blocks`` has the blocks of each term, bucketed by term. Without a
    folder the tables lie in the warehouse. Tables of the same name are replaced.
    """
    if buckets is None:
        index = materialize(index, "index")
        cores = index.sparkSession.sparkContext.defaultParallelism
        buckets = max(cores, -(-index.count() // BUCKET_ROWS))
    blocks = index.groupBy("term").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    for name, rows, key in (("rows", index, ["term", "block"]), ("blocks", blocks, ["term"])):
        writer = rows.repartition(buckets, *key).write.mode("overwrite").format("parquet")
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.bucketBy(buckets, *key).sortBy(*key).saveAsTable(f"{table}_{name}")


def lookup_batch(spark: SparkSession, table: str, wanted: DataFrame) -> DataFrame:
    """The rows of a keyed table for a batch of terms (term), as large as it may be.

    Only the batch moves, to the buckets or, if it is small, to all tasks. Repeated,
    absent and null terms are no error.
    """
    terms = materialize(wanted.select("term").where("term is not null").distinct(), "terms")
    keys = materialize(
        spark.table(f"{table}_blocks").join(terms, "term").select(
            "term", F.explode("blocks").alias("block")), "keys")
    return spark.table(f"{table}_rows").join(keys, ["term", "block"])
