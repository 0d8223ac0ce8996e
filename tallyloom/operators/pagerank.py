"""Personalized PageRank for several sources at once.

Only ranks above zero are kept between steps, as (id, source, p, slots). A step
joins them to the out-edges and adds up what arrives. What arrived is written as
one table per step: it is read for the missing mass as well as for the new ranks,
it cuts the lineage, and a later run can resume from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyloom.functions.measures import fixed_point, log_rank
from tallyloom.operators.graph import Graph
from tallyloom.plans.ranking import best_of_each
from tallyloom.plans.storage import new_folder, write_and_read

ALPHA = 0.15

# Out-edges per partition of the cached edges.
LINKS_PER_PARTITION = 2_000_000

_STATE = "id bigint, source bigint, q double, slots int"


def _sources(sources: list[int]) -> Column:
    return F.array(*[F.lit(s).cast("bigint") for s in dict.fromkeys(sources)])


def initial_ranks(graph: Graph, sources: list[int]) -> DataFrame:
    """One for each source at its own node."""
    seeds = graph.nodes.where(F.col("id").isin(sources))
    return seeds.select("id", F.col("id").alias("source"), F.lit(1.0).alias("p"), "slots")


def for_all_nodes(graph: Graph, values: DataFrame, sources: list[int], value: str) -> DataFrame:
    """(id, source, value) for every node and source, zero where there was no row."""
    slots = graph.nodes.select("id", F.explode(_sources(sources)).alias("source"))
    return slots.join(values.select("id", "source", value), ["id", "source"], "left").select(
        "id", "source", F.coalesce(value, F.lit(0.0)).alias(value)
    )


def received_mass(graph: Graph, ranks: DataFrame, sources: list[int],
                  counts: tuple[Observation, Observation] | None = None) -> DataFrame:
    """(id, source, q, slots): what each node receives from its in-neighbours.

    A source node always has its row, with q = 0 when nothing arrives. Of ``counts``,
    the first observes the ranks that move on, the second the messages that arrive.
    """
    moving = ranks.where(F.col("slots") > 0)
    if counts:
        moving = moving.observe(counts[0], F.count(F.lit(1)).alias("n"))
    sent = moving.select(
        F.col("id").alias("src"), "source", "p",
        F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
    )
    messages = sent.join(graph.links, ["src", "slot"]).select(
        F.col("dst").alias("id"), "source", (F.col("p") / F.col("degree")).alias("q"),
        F.col("dst_slots").alias("slots"),
    )
    if counts:
        messages = messages.observe(counts[1], F.count(F.lit(1)).alias("n"))
    own = initial_ranks(graph, sources).select("id", "source", F.lit(0.0).alias("q"), "slots")
    return (
        messages.unionByName(own)
        .groupBy("id", "source")
        .agg(F.sum("q").alias("q"), F.max("slots").alias("slots"))
    )


def missing_mass(received: DataFrame, sources: list[int]) -> DataFrame:
    """(source, m): what no node received, because of nodes without out-edges."""
    spark = received.sparkSession
    asked = spark.range(1).select(F.explode(_sources(sources)).alias("source"))
    sums = received.groupBy("source").agg(F.sum("q").alias("_q"))
    return asked.join(sums, "source", "left").select(
        "source", (1 - F.coalesce("_q", F.lit(0.0))).alias("m")
    )


def new_ranks(received: DataFrame, sources: list[int], alpha: float = ALPHA,
              mode: str = "standard") -> DataFrame:
    """Jump and missing mass go to the source.

    ``standard`` keeps the sum of the ranks at one. ``compat`` gives the source
    alpha * (1 - q) + q + m and agrees only while no mass is missing.
    """
    if mode not in ("standard", "compat"):
        raise ValueError(f"unknown mode {mode!r}")
    q, m = F.col("q"), F.col("m")
    at_source = alpha + (1 - alpha) * (q + m) if mode == "standard" else alpha * (1 - q) + q + m
    # One row per source that the caller named.
    missing = F.broadcast(missing_mass(received, sources))
    p = F.when(F.col("id") == F.col("source"), at_source).otherwise((1 - alpha) * q)
    return received.join(missing, "source").select("id", "source", p.alias("p"), "slots")


def _step_folder(folder: str, step: int) -> str:
    return f"{folder}/iter{step:04d}"


def ranks_at(graph: Graph, sources: list[int], folder: str, step: int, alpha: float = ALPHA,
             mode: str = "standard") -> DataFrame:
    """The ranks above zero after a saved step."""
    if step == 0:
        return initial_ranks(graph, sources)
    saved = graph.nodes.sparkSession.read.schema(_STATE).parquet(_step_folder(folder, step))
    return new_ranks(saved, sources, alpha, mode)


def cached_links(graph: Graph) -> Graph:
    """The graph with its edges in memory, placed by (src, slot) for the steps.

    A lost part is read again from the written edges. The cache is filled at
    once, since the steps avoid a shuffle of the edges only if Spark knows how
    they came to be placed.
    """
    links = graph.links
    cores = links.sparkSession.sparkContext.defaultParallelism
    partitions = max(cores, -(-links.count() // LINKS_PER_PARTITION))
    near = links.repartition(partitions, "src", "slot").persist()
    near.count()
    return Graph(graph.nodes, near)


def iterate(graph: Graph, sources: list[int], end: int, start: int = 0, folder: str | None = None,
            alpha: float = ALPHA, mode: str = "standard",
            statistics: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """Ranks above zero after the steps ``start`` to ``end - 1``.

    With a ``folder``, every step stays there, and a later call may start from it. To
    ``statistics`` a row is added for each step: its number from 1, the ranks that moved
    on and the messages that arrived, counted as the step runs, without a further pass.
    Rows that a lost task has to send again are counted again.
    """
    folder = folder or new_folder(graph.nodes.sparkSession, "pagerank")
    near = graph if graph.placed else cached_links(graph)
    try:
        for step in range(start, end):
            ranks = ranks_at(near, sources, folder, step, alpha, mode)
            counts = None if statistics is None else (Observation(), Observation())
            write_and_read(received_mass(near, ranks, sources, counts), _step_folder(folder, step + 1))
            if counts:
                statistics.append((step + 1, *(count.get["n"] for count in counts)))
    finally:
        if not graph.placed:
            near.links.unpersist()
    return ranks_at(graph, sources, folder, end, alpha, mode)


def personalized_pagerank(graph: Graph, sources: list[int], iterations: int, **options) -> DataFrame:
    """(id, source, p) for every node and source."""
    ranks = iterate(graph, sources, iterations, **options)
    return for_all_nodes(graph, ranks, sources, "p")


def with_log_rank(ranks: DataFrame) -> DataFrame:
    return ranks.select("id", "source", log_rank(F.col("p")).alias("log_p"))


def top_nodes(ranks: DataFrame, k: int) -> DataFrame:
    """The k best nodes of every source, ranked; ties go to the smaller id."""
    top = best_of_each(ranks, "source", [F.col("p").desc(), F.col("id")], k)
    return top.select("source", "rank", "id", "p", fixed_point(F.col("p")).alias("p_text"))
