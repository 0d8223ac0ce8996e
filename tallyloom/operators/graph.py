"""Directed graphs: nodes (id) and edges (src, dst), with repeated edges kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.lookups import lookup
from tallyloom.plans.storage import materialize

# The out-edges of a node are kept together up to this number, then in slots.
SLOT_EDGES = 100_000

# Links in a bucket of a stored graph.
BUCKET_LINKS = 2_000_000


@dataclass(frozen=True)
class Graph:
    """A graph prepared for iteration.

    ``nodes`` is (id, slots): into how many slots the out-edges of the node are
    split, 0 when it has none. ``links`` is (src, slot, dst, degree, dst_slots):
    the edges to known nodes, each with the out-degree of its source. Edges to
    unknown ids count in the degree, but nothing can arrive over them. ``placed``
    tells that the links already lie by (src, slot), so that steps join them as
    they are.
    """

    nodes: DataFrame
    links: DataFrame
    placed: bool = False


def build_graph(nodes: DataFrame, edges: DataFrame, slot_edges: int = SLOT_EDGES) -> Graph:
    degrees = materialize(edges.groupBy("src").agg(F.count("*").alias("degree")), "degrees")
    slots = F.ceil(F.col("degree") / F.lit(slot_edges)).cast("int")
    node_table = materialize(
        unique_nodes(nodes)
        .join(degrees.withColumnRenamed("src", "id"), "id", "left")
        .select("id", F.coalesce(slots, F.lit(0)).alias("slots")),
        "nodes",
    )
    arrivals = edges.groupBy("dst").agg(F.count("*").alias("n"))
    known = lookup(edges, node_table.select(F.col("id").alias("dst"), F.col("slots").alias("dst_slots")),
                   "dst", weight=arrivals)
    out = lookup(known, degrees.withColumn("_slots", slots), "src",
                 weight=degrees.withColumnRenamed("degree", "n"))
    # Any slot will do; copies of an edge must not all get the same one. The links of a
    # node are written together, so they and the steps' shuffle of them take less room.
    links = out.select(
        "src", F.floor(F.rand(7) * F.col("_slots")).cast("int").alias("slot"),
        "dst", "degree", "dst_slots",
    ).sortWithinPartitions("src")
    return Graph(node_table, materialize(links, "links"))


def save_graph(graph: Graph, folder: str) -> None:
    """Store a prepared graph, for any number of later runs."""
    graph.nodes.write.mode("overwrite").parquet(f"{folder}/nodes")
    graph.links.write.mode("overwrite").parquet(f"{folder}/links")


def load_graph(spark: SparkSession, folder: str) -> Graph:
    return Graph(spark.read.parquet(f"{folder}/nodes"), spark.read.parquet(f"{folder}/links"))


def save_bucketed(graph: Graph, table: str, folder: str | None = None, buckets: int | None = None) -> None:
    """Store a prepared graph as the catalog tables ``table_nodes`` and ``table_links``.

    The links are bucketed by (src, slot), which is what a step joins on, so no later
    run shuffles them; a slot bounds the links of a key, so buckets are even. Without a
    folder the tables lie in the warehouse.
    """
    if buckets is None:
        cores = graph.links.sparkSession.sparkContext.defaultParallelism
        buckets = max(cores, -(-graph.links.count() // BUCKET_LINKS))
    for name, rows in (("nodes", graph.nodes), ("links", graph.links.repartition(buckets, "src", "slot"))):
        writer = rows.write.mode("overwrite").format("parquet")
        if name == "links":
            writer = writer.bucketBy(buckets, "src", "slot").sortBy("src", "slot")
        if folder:
            writer = writer.option("path", f"{folder}/{name}")
        writer.saveAsTable(f"{table}_{name}")


def load_bucketed(spark: SparkSession, table: str) -> Graph:
    return Graph(spark.table(f"{table}_nodes"), spark.table(f"{table}_links"), placed=True)


def duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """(id, n) for ids with more than one node."""
    return nodes.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > 1)


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes; the job fails when an id occurs twice."""
    counted = nodes.groupBy("id").agg(F.count("*").alias("_n"))
    problem = F.raise_error(F.format_string("several nodes with id %d", F.col("id")))
    return counted.select(F.when(F.col("_n") == 1, F.col("id")).otherwise(problem).alias("id"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, and nodes with out-edges."""
    out = edges.groupBy("src").agg(F.count("*").alias("n"))
    sums = out.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_edges"), F.count("*").alias("n_active_nodes")
    )
    return sums.select(
        nodes.agg(F.count("*").alias("n")).scalar().alias("n_nodes"), "n_edges", "n_active_nodes"
    )


def partition_graph(graph: Graph, partitions: int, by_range: bool = False) -> Graph:
    """The same graph in the given number of partitions, by hash or range of the id.

    The slot belongs to the key, so a node with very many edges is spread.
    """
    if by_range:
        return Graph(
            graph.nodes.repartitionByRange(partitions, "id"),
            graph.links.repartitionByRange(partitions, "src", "slot"),
        )
    return Graph(
        graph.nodes.repartition(partitions, "id"),
        graph.links.repartition(partitions, "src", "slot"),
    )


def missing_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, n_messages) for ids that edges lead to although there is no such node."""
    arrivals = edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("n_messages"))
    return arrivals.join(nodes, "id", "left_anti")


def step_stats(nodes: DataFrame, edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """One row on the messages of the step that goes on from ``ranks`` (id, source, p).

    Every rank above zero goes over all out-edges of its node. ``n_received`` counts
    the messages that reach a node, ``n_missing`` the unknown ids that others lead to.
    """
    moving = ranks.where(F.col("p") > 0).groupBy(F.col("id").alias("src"))
    moving = materialize(moving.agg(F.count("*").alias("n")), "moving")
    arrived = lookup(edges.select("src", "dst"), moving, "src").groupBy(
        F.col("dst").alias("id")).agg(F.sum("n").alias("n"))
    there = F.col("known").isNotNull()
    sums = arrived.join(
        nodes.select("id", F.lit(True).alias("known")).distinct(), "id", "left"
    ).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_sent"),
        F.coalesce(F.sum(F.when(there, F.col("n"))), F.lit(0)).alias("n_received"),
        F.count_if(~there).alias("n_missing"),
    )
    return sums.select(
        nodes.agg(F.count("*").alias("n")).scalar().alias("n_nodes"),
        edges.agg(F.count("*").alias("n")).scalar().alias("n_edges"),
        "n_sent", "n_received", "n_missing",
    )
