"""Tab separated event files: id, user name, creation time, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.times import parse_creation_time

EVENT_SCHEMA = "id bigint, user_name string, creation_time string, text string"


def read_event_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Typed columns and ``time`` in UTC.

    Quotes are plain characters. A short row has NULL in its missing columns, a
    long one loses the extra fields, an id that is no number is NULL.
    """
    rows = spark.read.schema(EVENT_SCHEMA).csv(
        path, sep="\t", quote="", mode="PERMISSIVE", enforceSchema=True
    )
    return rows.withColumn("time", parse_creation_time(F.col("creation_time")))


def split_event_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The same columns from lines that are already in a DataFrame, ragged or not."""
    fields = F.split(F.col(line), "\t")
    rows = lines.withColumn("_fields", fields)
    return rows.select(
        *lines.columns,
        _field(0).try_cast("bigint").alias("id"),
        _field(1).alias("user_name"),
        _field(2).alias("creation_time"),
        _field(3).alias("text"),
        parse_creation_time(_field(2)).alias("time"),
    )


def checked_event_lines(lines: DataFrame, line: str = "line", fields: int = 4) -> DataFrame:
    """The columns of ``split_event_lines`` and ``reason``, why the line is no event.

    ``reason`` is NULL for a sound line. A line must have at least ``fields`` and at most
    four fields, a number as its id and, if the time is among its fields, a valid time.
    The first reason in this order is given.
    """
    size = F.size(F.split(F.col(line), "\t"))
    reason = (
        F.when(F.col(line).isNull() | (F.trim(F.col(line)) == ""), "empty line")
        .when(size < fields, "too few fields")
        .when(size > 4, "too many fields")
        .when(F.col("id").isNull(), "id is no number")
        .when((size >= 3) & F.col("time").isNull(), "no valid time")
    )
    return split_event_lines(lines, line).withColumn("reason", reason)


def store_checked_events(lines: DataFrame, folder: str, line: str = "line",
                         fields: int = 4) -> tuple[DataFrame, DataFrame]:
    """Sound events (id, user_name, creation_time, text, time) and rejected lines (line, reason).

    Both are written in one pass over the lines, each to a directory of its own, so that
    every line is in one of them.
    """
    checked = checked_event_lines(lines.select(F.col(line).alias("line")), fields=fields)
    checked.withColumn("sound", F.col("reason").isNull()).write.mode("overwrite").partitionBy(
        "sound").parquet(folder)
    stored = lines.sparkSession.read.schema(f"{checked.schema.toDDL()}, sound boolean").parquet(folder)
    return (
        stored.where("sound").select("id", "user_name", "creation_time", "text", "time"),
        stored.where("not sound").select("line", "reason"),
    )


def read_checked_events(spark: SparkSession, path: str, folder: str,
                        fields: int = 4) -> tuple[DataFrame, DataFrame]:
    """Sound events and rejected lines of text files, stored in the folder."""
    return store_checked_events(
        spark.read.text(path).withColumnRenamed("value", "line"), folder, fields=fields)


def _field(position: int) -> Column:
    return F.get("_fields", F.lit(position))
