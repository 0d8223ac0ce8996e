"""Joining large rows to a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.storage import materialize

BROADCAST_BYTES = 64 << 20

# A task that hashes its part of a table should meet this many bytes of it.
HASHED_BYTES = 64 << 20

# A key is heavy when it holds more than one in this many rows, so there can
# never be more heavy keys than this.
HEAVY_SHARE = 1024

# Over how many join keys the rows of the heavy keys are spread.
SPREAD = 4096


def _bytes_of(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value beside the eight that any value takes in its row."""
    none = F.lit(0).cast("long")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value).cast("long"), none)
    if isinstance(kind, T.StructType):
        row = F.lit(8 + 8 * len(kind.fields)).cast("long")
        for field in kind.fields:
            row = row + _bytes_of(value.getField(field.name), field.dataType)
        return row
    if isinstance(kind, T.ArrayType):
        if not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)):
            return 8 * F.greatest(F.size(value).cast("long"), none)
        inner = F.transform(value, lambda x: _bytes_of(x, kind.elementType) + 16)
        return F.coalesce(F.aggregate(inner, none, lambda a, x: a + x), none)
    return none


def measured(table: DataFrame) -> int:
    """Bytes of the rows of a written table of numbers, strings, binaries, and structs and arrays of them."""
    row = F.lit(16 + 8 * len(table.columns)).cast("long")
    for field in table.schema.fields:
        row = row + _bytes_of(F.col(f"`{field.name}`"), field.dataType)
    return table.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(table: DataFrame, limit: int | None = None) -> bool:
    return measured(table) <= (BROADCAST_BYTES if limit is None else limit)


def lookup(rows: DataFrame, table: DataFrame, key: str, weight: DataFrame | None = None,
           limit: int | None = None) -> DataFrame:
    """Inner join of ``rows`` to ``table``, which has one row per ``key``.

    A table measured below the limit is broadcast. A larger one is shuffled, but
    the heavy keys, whose number is bounded by their share of the rows, are
    broadcast on their own, so no task receives all rows of a heavy key.
    ``weight`` (key, n) gives the rows per key where that is already known.
    """
    size = measured(table)
    if size <= (BROADCAST_BYTES if limit is None else limit):
        return rows.join(F.broadcast(table), key)
    if weight is None:
        rows = materialize(rows, "rows")
        weight = rows.groupBy(key).agg(F.count("*").alias("n"))
    sums = weight.agg(F.sum("n").alias("n"), F.max("n").alias("most")).first()
    if sums["n"] and sums["most"] * HEAVY_SHARE > sums["n"]:
        return heavy_key_lookup(rows, table, key, weight)
    # Without a heavy key the rows need no place. They are not sorted either where a
    # task's part of the table, which has one row per key, is small.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.join(table.hint("shuffle_hash") if size <= tasks * HASHED_BYTES else table, key)


def heavy_key_lookup(rows: DataFrame, table: DataFrame, key: str,
                     weight: DataFrame | None = None) -> DataFrame:
    if weight is None:
        rows = materialize(rows, "rows")
        weight = rows.groupBy(key).agg(F.count("*").alias("n"))
    weight = materialize(weight.select(key, "n"), "weights")
    total = weight.agg(F.sum("n").alias("n")).first()["n"] or 0
    heavy = weight.where(F.col("n") > total / HEAVY_SHARE).select(key)
    payload = [c for c in table.columns if c != key]
    packed = table.select(key, F.struct(*payload).alias("_found"))
    hot = packed.join(F.broadcast(heavy), key, "left_semi").withColumnRenamed("_found", "_hot")
    hot = materialize(hot, "heavy")

    # Rows of heavy keys are answered already. They go on with one of many places
    # that no table row has; key and place are one struct, because the optimizer
    # would take a constant place out of the join key.
    tagged = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_place",
        F.when(F.col("_hot").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)) + 1),
    ).withColumn("_key", F.struct(F.col(key).alias("key"), F.col("_place").alias("place")))
    cold = packed.select(
        F.struct(F.col(key).alias("key"), F.lit(0).cast("bigint").alias("place")).alias("_key"),
        "_found",
    )
    return (
        tagged.join(cold, "_key", "left")
        .withColumn("_found", F.coalesce("_hot", "_found"))
        .where(F.col("_found").isNotNull())
        .select(*rows.columns, "_found.*")
    )
