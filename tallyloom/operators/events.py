"""Hourly event counts over rows with a ``time`` in UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import has_keyword
from tallyloom.functions.times import (
    PADDED_HOUR,
    UNPADDED_HOUR,
    between_exclusive,
    hour_label,
    hour_of,
)


def in_range(events: DataFrame, low: str, high: str) -> DataFrame:
    return events.where(between_exclusive(F.col("time"), low, high))


def with_keyword(events: DataFrame, keywords: list[str], text: str = "text") -> DataFrame:
    return events.where(has_keyword(F.col(text), keywords))


def hourly_counts(events: DataFrame) -> DataFrame:
    """(hour, n) with labels like ``01/23 00``, in order of time.

    Hours are grouped with their year, so equal labels of two years stay apart.
    """
    counts = events.where(F.col("time").isNotNull()).groupBy(hour_of(F.col("time")).alias("_hour"))
    counts = counts.agg(F.count("*").alias("n")).orderBy("_hour")
    return counts.select(hour_label(F.col("_hour"), PADDED_HOUR).alias("hour"), "n")


def hourly_counts_unpadded(events: DataFrame) -> DataFrame:
    """(hour, n) with labels like ``1/23 0``, in text order of the labels.

    The label is the key, so the same hour of two years counts together.
    """
    label = hour_label(F.col("time"), UNPADDED_HOUR).alias("hour")
    counts = events.where(F.col("time").isNotNull()).groupBy(label)
    return counts.agg(F.count("*").alias("n")).orderBy("hour")
