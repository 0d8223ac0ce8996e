"""Adjacency lines: ``id neighbour neighbour ...``, or ``id`` alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import index_tokens


def read_adjacency(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id) and edges (src, dst) of the files."""
    return parse_adjacency(spark.read.text(path), "value")


def parse_adjacency(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """One node row per line, one edge row per neighbour, repeats kept."""
    ids = lines.select(F.transform(index_tokens(F.col(line)), lambda t: t.cast("bigint")).alias("ids"))
    ids = ids.where(F.size("ids") > 0)
    nodes = ids.select(F.col("ids")[0].alias("id"))
    edges = ids.select(
        F.col("ids")[0].alias("src"),
        F.explode(F.expr("slice(ids, 2, size(ids))")).alias("dst"),
    )
    return nodes, edges
