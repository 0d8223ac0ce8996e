import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import graph as gr
from tallyloom.operators import pagerank as pr
from tallyloom.plans import lookups
from tallyloom.sources.adjacency import parse_adjacency


def frames(spark, adjacency):
    lines = [" ".join(map(str, (i, *out))) for i, out in adjacency.items()]
    return parse_adjacency(spark.createDataFrame([(line,) for line in lines], "line string"))


def build(spark, adjacency, **options):
    return gr.build_graph(*frames(spark, adjacency), **options)


def brute(adjacency, sources, steps, mode="standard", alpha=0.15):
    ranks = {(i, s): float(i == s) for i in adjacency for s in sources}
    missing = []
    for _ in range(steps):
        mass = dict.fromkeys(ranks, 0.0)
        for i, out in adjacency.items():
            for j in out:
                for s in sources:
                    if (j, s) in mass:
                        mass[j, s] += ranks[i, s] / len(out)
        m = {s: 1 - sum(q for (_, t), q in mass.items() if t == s) for s in sources}
        missing.append(m)
        for (i, s), q in mass.items():
            if i != s:
                ranks[i, s] = (1 - alpha) * q
            elif mode == "standard":
                ranks[i, s] = alpha + (1 - alpha) * (q + m[s])
            else:
                ranks[i, s] = alpha * (1 - q) + q + m[s]
    return ranks, missing


def as_dict(ranks):
    return {(r.id, r.source): r.p for r in ranks.collect()}


def close(found, expected):
    return found.keys() == expected.keys() and all(
        math.isclose(found[k], expected[k], abs_tol=1e-12) for k in expected
    )


# Node 4 has no out-edges, 99 is no node, 5 has 12 neighbours, 2 has a repeated edge.
SMALL = {1: [2, 3, 99], 2: [3, 3, 1], 3: [1, 4], 4: [], 5: [1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 13],
         **{i: [5] for i in range(6, 14)}}


def test_adjacency_lines(spark):
    lines = spark.createDataFrame([(" 1  2\t3 ",), ("4",), ("",)], "line string")
    nodes, edges = parse_adjacency(lines)
    assert sorted(r.id for r in nodes.collect()) == [1, 4]
    assert sorted(tuple(r) for r in edges.collect()) == [(1, 2), (1, 3)]


def test_initial_ranks_of_adjacent_sources(spark):
    built = build(spark, SMALL)
    dense = pr.for_all_nodes(built, pr.initial_ranks(built, [1, 2, 2]), [1, 2, 2], "p")
    assert as_dict(dense) == {(i, s): float(i == s) for i in SMALL for s in (1, 2)}


def test_stats_and_missing_nodes(spark):
    nodes, edges = frames(spark, SMALL)
    assert tuple(gr.graph_stats(nodes, edges).first()) == (13, 28, 12)
    assert [tuple(r) for r in gr.missing_nodes(nodes, edges).collect()] == [(99, 1)]
    # Node 1 sends to 2, 3 and the unknown 99; node 2 sends twice to 3 and once to 1.
    ranks = pr.initial_ranks(gr.build_graph(nodes, edges), [1, 2])
    assert tuple(gr.step_stats(nodes, edges, ranks).first()) == (13, 28, 6, 5, 1)
    assert tuple(gr.step_stats(nodes, edges, ranks.where("p > 1")).first()) == (13, 28, 0, 0, 0)


def test_a_repeated_node_fails_the_build(spark):
    nodes, edges = parse_adjacency(spark.createDataFrame([("1 2",), ("1 3",), ("2",)], "line string"))
    assert [tuple(r) for r in gr.duplicate_nodes(nodes).collect()] == [(1, 2)]
    with pytest.raises(Exception, match="several nodes with id 1"):
        gr.build_graph(nodes, edges)


@pytest.mark.parametrize("mode", ["standard", "compat"])
def test_ranks_equal_brute_force(spark, mode):
    expected, _ = brute(SMALL, [1, 5], 4, mode)
    found = pr.personalized_pagerank(build(spark, SMALL), [1, 5], 4, mode=mode)
    assert close(as_dict(found), expected)


def test_mass_adds_up(spark):
    built = build(spark, SMALL)

    def total(mode, n):
        ranks = pr.personalized_pagerank(built, [1, 5], n, mode=mode)
        return dict(ranks.groupBy("source").agg(F.sum("p")).collect())

    assert all(math.isclose(p, 1) for p in total("standard", 3).values())
    _, missing = brute(SMALL, [1, 5], 1, "compat")
    assert all(math.isclose(p, 1 + 0.15 * missing[0][s]) for s, p in total("compat", 1).items())


def test_missing_mass_and_received_mass(spark):
    built = build(spark, SMALL)
    received = pr.received_mass(built, pr.initial_ranks(built, [1, 4]), [1, 4])
    missing = {r.source: r.m for r in pr.missing_mass(received, [1, 4]).collect()}
    assert close(missing, {1: 1 / 3, 4: 1.0})
    dense = {(r.id, r.source): r.q for r in pr.for_all_nodes(built, received, [1, 4], "q").collect()}
    assert len(dense) == 26 and math.isclose(dense[2, 1], 1 / 3) and dense[4, 4] == 0


def test_a_source_that_is_no_node_keeps_all_ranks_zero(spark):
    found = as_dict(pr.personalized_pagerank(build(spark, SMALL), [1, 1000], 2))
    expected, _ = brute(SMALL, [1, 1000], 2)
    assert close(found, expected) and all(p == 0 for (_, s), p in found.items() if s == 1000)


@pytest.fixture(scope="module")
def skewed():
    """One node holds about a third of the out-edges, another of the in-edges."""
    chance = random.Random(11)
    adjacency = {i: [chance.randrange(60) for _ in range(chance.randint(0, 3))] + [1] for i in range(60)}
    adjacency[0] = [chance.randrange(70) for _ in range(60)]
    adjacency[7] = []
    return adjacency


def test_copies_of_an_edge_are_spread_over_the_slots(spark):
    built = build(spark, {1: [2] * 1000, 2: []}, slot_edges=100)
    counts = [r["count"] for r in built.links.groupBy("slot").count().collect()]
    assert len(counts) == 10 and max(counts) < 200


@pytest.mark.parametrize("slot_edges", [100_000, 5])
def test_a_hub_in_slots_gives_the_same_ranks(spark, skewed, slot_edges):
    built = build(spark, skewed, slot_edges=slot_edges)
    assert (built.links.agg(F.max("slot")).first()[0] > 0) == (slot_edges == 5)
    expected, _ = brute(skewed, [0, 1, 7], 3)
    assert close(as_dict(pr.personalized_pagerank(built, [0, 1, 7], 3)), expected)


def test_ranks_without_any_broadcast_table(spark, skewed, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookups, "HEAVY_SHARE", 8)
    expected, _ = brute(skewed, [0, 1], 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = build(spark, skewed, slot_edges=5)
        assert close(as_dict(pr.personalized_pagerank(built, [0, 1], 3)), expected)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cached_edges_are_not_shuffled_again(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    near = pr.cached_links(build(spark, skewed))
    try:
        step = pr.received_mass(near, pr.initial_ranks(near, [0, 1]), [0, 1])
        plan = step._jdf.queryExecution().executedPlan().toString()
    finally:
        near.links.unpersist()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = plan.split("InMemoryRelation")[0]
    assert plan.count("Exchange hashpartitioning(src") == 1 and "SortMergeJoin" in plan


@pytest.mark.parametrize("by_range", [False, True])
def test_partitions_do_not_change_ranks(spark, by_range):
    built = gr.partition_graph(build(spark, SMALL), 5, by_range)
    assert built.links.rdd.getNumPartitions() == 5
    expected, _ = brute(SMALL, [1], 2)
    assert close(as_dict(pr.personalized_pagerank(built, [1], 2)), expected)


def test_a_run_resumes_from_a_saved_step(spark, tmp_path):
    built, folder = build(spark, SMALL), str(tmp_path / "ranks")
    pr.iterate(built, [1, 5], 2, folder=folder)
    assert sorted(p.name for p in (tmp_path / "ranks").iterdir()) == ["iter0001", "iter0002"]
    resumed = pr.personalized_pagerank(built, [1, 5], 5, start=2, folder=folder)
    assert close(as_dict(resumed), brute(SMALL, [1, 5], 5)[0])


def test_a_stored_graph_gives_the_same_ranks(spark, tmp_path):
    gr.save_graph(build(spark, SMALL), str(tmp_path))
    loaded = gr.load_graph(spark, str(tmp_path))
    assert close(as_dict(pr.personalized_pagerank(loaded, [1, 5], 2)), brute(SMALL, [1, 5], 2)[0])


def test_log_rank_and_top_nodes(spark):
    ranks = spark.createDataFrame(
        [(1, 9, 0.5), (2, 9, 0.25), (3, 9, 0.25), (4, 9, 0.0), (1, 8, 0.036125), (2, 8, 1.0)],
        "id bigint, source bigint, p double",
    )
    logs = {(r.id, r.source): r.log_p for r in pr.with_log_rank(ranks).collect()}
    assert logs[4, 9] == -math.inf and logs[2, 8] == 0
    top = [tuple(r) for r in pr.top_nodes(ranks, 2).orderBy("source", "rank").collect()]
    assert top == [(8, 1, 2, 1.0, "1.00000"), (8, 2, 1, 0.036125, "0.03613"),
                   (9, 1, 1, 0.5, "0.50000"), (9, 2, 2, 0.25, "0.25000")]


@pytest.fixture
def bucketed(spark, tmp_path):
    """A ring with a hub, stored in buckets, and the same graph as it was built."""
    edges = [(n, (n + 1) % 60) for n in range(60)] + [(7, n) for n in range(60)] + [(n, 7) for n in range(0, 60, 3)]
    edges += [(5, 1000), (5, 1001)]
    built = gr.build_graph(
        spark.createDataFrame([(n,) for n in range(61)], "id bigint"),
        spark.createDataFrame(edges, "src bigint, dst bigint"), slot_edges=8)
    table = "ring_" + tmp_path.name.replace("-", "_")
    gr.save_bucketed(built, table, str(tmp_path / "graph"), buckets=4)
    yield built, gr.load_bucketed(spark, table), edges
    for name in ("nodes", "links"):
        spark.sql(f"DROP TABLE {table}_{name}")


def test_a_bucketed_graph_gives_the_same_ranks_again_and_again(bucketed):
    built, stored, _ = bucketed
    for sources in ([1, 2], [7, 60]):
        wanted, found = ({(r[0], r[1]): r[2] for r in pr.personalized_pagerank(g, sources, 2).collect()}
                         for g in (built, stored))
        assert found.keys() == wanted.keys()
        assert all(abs(found[k] - wanted[k]) < 1e-12 for k in wanted)


def test_steps_neither_shuffle_nor_cache_bucketed_links(spark, bucketed):
    _, stored, _ = bucketed
    pr.iterate(stored, [1], 1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranks = pr.initial_ranks(stored, [1, 7])
        plan = pr.received_mass(stored, ranks, [1, 7])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    links = next(line for line in plan.splitlines() if "dst_slots" in line and "FileScan" in line)
    assert "Bucketed: true" in links
    above = plan.splitlines()[:plan.splitlines().index(links)]
    depth = len(links) - len(links.lstrip(" :+-"))
    path = [line for i, line in enumerate(above) if not any(
        len(x) - len(x.lstrip(" :+-")) <= len(line) - len(line.lstrip(" :+-")) for x in [*above[i + 1:], links])]
    join = max(i for i, line in enumerate(path) if "Join" in line)
    assert depth > 0 and not any("Exchange" in line for line in path[join:])
    assert spark._jsc.sc().getPersistentRDDs().size() == 0


def test_statistics_are_counted_as_the_steps_run(bucketed):
    built, stored, edges = bucketed
    for g in (built, stored):
        statistics = []
        pr.iterate(g, [1, 7], 2, statistics=statistics)
        reached = {1: {1}, 7: {7}}
        known = set(range(61))
        for step, moving, messages in statistics:
            out = {s: [d for n in held for a, d in edges if a == n] for s, held in reached.items()}
            assert moving == sum(any(a == n for a, _ in edges) for held in reached.values() for n in held)
            assert messages == sum(d in known for found in out.values() for d in found)
            reached = {s: {d for d in found if d in known} | {s} for s, found in out.items()}
        assert [row[0] for row in statistics] == [1, 2]


def test_links_of_a_node_are_written_together(spark, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", -1)
    nodes = spark.range(500)
    edges = spark.range(4000).selectExpr("id * 7 % 500 as src", "id * 13 % 600 as dst")
    links = gr.build_graph(nodes, edges).links
    parts = links.select(F.col("_metadata.file_name").alias("part"), F.monotonically_increasing_id().alias("at"), "src")
    rows = [(r.part, r.src) for r in parts.orderBy("part", "at").collect()]
    assert rows == sorted(rows) and len(rows) == edges.where("dst < 500").count()
