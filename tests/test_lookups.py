import pytest
from pyspark.sql import functions as F

from tallyloom.plans import lookups
from tallyloom.plans.storage import materialize, spread


@pytest.fixture(scope="module")
def tables(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 1200, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 150)).alias("k"),
        F.col("id").alias("v"),
    )
    table = spark.range(140).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("w"))
    table = table.unionByName(spark.createDataFrame([("hot", -1)], "k string, w bigint"))
    return rows, materialize(table)


def test_both_ways_give_the_same_rows(tables, monkeypatch):
    rows, table = tables
    monkeypatch.setattr(lookups, "HEAVY_SHARE", 10)
    usual = sorted(lookups.lookup(rows, table, "k").collect())
    assert len(usual) == rows.join(table, "k").count()
    heavy = lookups.lookup(rows, table, "k", limit=-1)
    assert sorted(heavy.select(*usual[0].__fields__).collect()) == usual
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    known = lookups.lookup(rows, table, "k", weight=counts, limit=-1)
    assert sorted(known.select(*usual[0].__fields__).collect()) == usual


@pytest.mark.parametrize("hashed", [64 << 20, -1])
def test_rows_without_a_heavy_key_are_joined_as_they_are(tables, monkeypatch, hashed):
    rows, table = tables
    monkeypatch.setattr(lookups, "HEAVY_SHARE", 2)
    monkeypatch.setattr(lookups, "HASHED_BYTES", hashed)
    usual = sorted(tuple(r) for r in rows.join(table, "k").collect())
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    for weight in (None, counts):
        found = lookups.lookup(rows, table, "k", weight=weight, limit=-1)
        assert sorted(tuple(r) for r in found.collect()) == usual
        plan = found._jdf.queryExecution().toString()
        assert "_place" not in plan and ("shuffle_hash" in plan) == (hashed > 0)
    assert lookups.lookup(rows.limit(0), table, "k", limit=-1).count() == 0


def test_rows_of_a_heavy_key_spread_over_the_tasks(spark, tables, monkeypatch):
    rows, table = tables
    monkeypatch.setattr(lookups, "HEAVY_SHARE", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookups.heavy_key_lookup(rows, table, "k")
        place = joined.where(F.col("k") == "hot").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [r["count"] for r in place]
    assert sum(sizes) == 1200 and len(sizes) == 8 and max(sizes) < 400


def test_size_is_measured(tables):
    _, table = tables
    assert lookups.fits_broadcast(table)
    assert not lookups.fits_broadcast(table, 1000)
    assert lookups.fits_broadcast(table.where(F.lit(False)), 0)


def test_structs_and_arrays_are_measured(spark):
    """A row, its columns, the fields of structs and what strings and elements hold."""
    rows = spark.createDataFrame(
        [((1, "four"), [b"abc", None], [(7, "xy")], [[1, 2]], b"12"), (None,) * 5],
        "`a.b` struct<id:long,text:string>, bins array<binary>, cells array<struct<n:long,s:string>>, "
        "lists array<array<int>>, raw binary")
    fixed = 2 * (16 + 8 * 5)
    assert lookups.measured(rows) == fixed + (24 + 4 + 24) + (16 + 3 + 16) + (16 + 24 + 2) + (16 + 16) + 2
    ids = spark.range(1000).select(F.struct("id", F.xxhash64("id").alias("text")).alias("_key"))
    assert lookups.measured(ids) == 1000 * (24 + 24)
    assert not lookups.fits_broadcast(ids, 1000 * 24)


def test_spread_leaves_wide_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 9)
    assert spread(wide) is wide
    assert spread(spark.range(0, 100, 1, 2)).rdd.getNumPartitions() == 8
