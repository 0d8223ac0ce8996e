"""Documents numbered without gaps, and stored in the order of their numbers.

The ordinal of a document is its place among all documents by id, whatever the ids are:
hashes, byte offsets or negative numbers. Blocks of ordinals are all full but the last,
so a term has as many index rows as its documents need, and bitmaps of a block are dense.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.plans.lookups import fits_broadcast
from tallyloom.plans.storage import materialize

# Fixed value: the documents in one bitmap of Spark's bitmap functions.
BLOCK_DOCS = 32768

# Spark's row number within a partition takes the lower 33 bits of its increasing id.
_ROW_BITS = 33


def with_ordinals(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows with ``ordinal``, their place from 0 by the keys, nulls first.

    The rows are range partitioned once and written with their place in the partition;
    the sizes of the partitions before, one number each, are added when they are read.
    """
    order = [F.col(key).asc_nulls_first() for key in keys]
    placed = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row for each partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = materialize(sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")), "firsts")
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(firsts), "_part").select(
        *rows.columns, (F.col("_first") + row).alias("ordinal"))


def block_of(ordinal: str, block_docs: int = BLOCK_DOCS):
    return F.expr(f"{ordinal} div {block_docs}")


def write_store(documents: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
                block_docs: int = BLOCK_DOCS) -> None:
    """Store documents by ordinal as (doc_id, text, ordinal), a directory for each block.

    The texts are shuffled once; blocks are written from where they lie.
    """
    numbered = with_ordinals(documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "doc_id")
    numbered.withColumn("block", block_of("ordinal", block_docs)).sortWithinPartitions("block", "ordinal").write.mode(
        "overwrite").partitionBy("block").parquet(folder)


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id bigint, text string, ordinal bigint, block bigint").parquet(folder)


def fetch(hits: DataFrame, store: DataFrame, *columns: str, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Hits (ordinal, ...) with columns of their documents.

    Hits below the broadcast limit also tell the scan which blocks it has to read; other
    directories are not opened. More hits than that are joined by a shuffle of both sides.
    """
    found = materialize(hits.withColumn("block", block_of("ordinal", block_docs)), "hits")
    # The comparison, true of every ordinal, lets the optimizer prune by this side.
    asked = found.where("ordinal >= 0")
    near = F.broadcast(asked) if fits_broadcast(found) else asked
    return store.select("block", "ordinal", *columns).join(near, ["block", "ordinal"]).select(
        *hits.columns, *columns)
