"""The best rows of every group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Into how many parts the rows of a group are cut before they are ranked.
PARTS = 256


def best_of_each(rows: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The k first rows of every group in the order, numbered from 1 as ``rank``.

    Each of the parts of a group gives its own k first rows, so that no task sorts
    a whole group, however large k is.
    """
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(PARTS))
    in_part = Window.partitionBy(group, "_part").orderBy(*order)
    firsts = rows.withColumn("_part", part).withColumn("rank", F.row_number().over(in_part))
    whole = Window.partitionBy(group).orderBy(*order)
    ranked = firsts.where(F.col("rank") <= k).drop("_part").withColumn("rank", F.row_number().over(whole))
    return ranked.where(F.col("rank") <= k)
