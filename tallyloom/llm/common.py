"""Parts that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.lookups import BROADCAST_BYTES, measured
from tallyloom.plans.storage import materialize

# What separates words, as a Java and Python pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"


def crc_of_id(doc_id: str) -> Column:
    """The unsigned CRC-32 of the id written as text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True for ids whose checksum leaves the remainder; false for a null id."""
    return F.coalesce(crc_of_id(doc_id) % modulus == remainder, F.lit(False))


def utf8_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def small_side(table: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast if it measures below the limit.

    Beyond the limit the join shuffles both sides; the rows are the same.
    """
    return F.broadcast(table) if measured(table) <= limit else table


def running_totals(ordered: DataFrame, size: str) -> DataFrame:
    """Add ``end`` (running sum of ``size``) and ``index`` (row number from 0) over the order.

    ``ordered`` is range partitioned and sorted within its partitions. Each
    partition counts for itself and is written once; then the totals of the
    partitions before it, one small row for each partition, are added.
    """
    fields = ordered.schema.simpleString()[len("struct<"):-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        total, rows = 0, 0
        for batch in batches:
            n = batch.num_rows
            ends = total + np.cumsum(batch.column(size).to_numpy(zero_copy_only=False).astype("i8"))
            columns = [*batch.columns, pa.array(np.full(n, part, "i4")), pa.array(ends),
                       pa.array(np.arange(rows, rows + n, dtype="i8"))]
            if n:
                total, rows = int(ends[-1]), rows + n
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_part", "_end", "_index"])

    counted = materialize(
        ordered.mapInArrow(count, f"{fields}, _part int, _end long, _index long"), "ordered")
    parts = (
        counted.groupBy("_part").agg(F.max("_end").alias("e"), (F.max("_index") + 1).alias("n"))
        .orderBy("_part").collect()
    )
    offsets, end, index = [], 0, 0
    for part, e, n in parts:
        offsets.append((part, end, index))
        end, index = end + e, index + n
    before = ordered.sparkSession.createDataFrame(offsets, "_part int, _e long, _i long")
    return counted.join(F.broadcast(before), "_part").select(
        *ordered.columns, (F.col("_end") + F.col("_e")).alias("end"),
        (F.col("_index") + F.col("_i")).alias("index"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (a, b): rows (node, root), root the smallest node.

    Alternating large-star and small-star rounds, each written to the shared
    folder. A large-star round links the larger neighbours of every node to the
    least node next to it, a small-star round does so with the smaller ones; both
    keep the components and end in one star for each component. The smallest
    neighbour is found with partial aggregation and written, so that the join to
    it has two plain shuffles whose hot keys can be split at run time.
    """
    edges = materialize(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), "edges")

    def mark(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    def star(pairs: DataFrame, toward_larger: bool) -> DataFrame:
        """pairs (u, v): link the wanted neighbours v of u to the least of u and all v."""
        least = materialize(
            pairs.groupBy("u").agg(F.min("v").alias("m"))
            .select("u", F.least("u", "m").alias("m")), "least")
        linked = pairs.join(least, "u")
        if toward_larger:
            out = linked.where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        else:
            out = linked.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
                least.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return materialize(out.where("a <> b").distinct(), "stars")

    before = None
    while True:
        now = mark(edges)
        if now == before:
            break
        before = now
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        edges = star(both, True)
        edges = star(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), False)
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
