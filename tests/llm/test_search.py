"""Top-k search, the pipeline and the registry."""

import math
import random

import corpus_pipeline
import numpy as np
import pytest
from check_queries import difference, oracle_connection
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tallyloom.llm import queries, topk


def brute(rows, modulus, k):
    sound = [(i, [math.floor(1024 * x) for x in np.float32(v).tolist()]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if q % modulus == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 2048])
def test_topk(spark, clashing, block):
    rng = np.random.default_rng(0)
    rows = [(int(i), rng.normal(size=8).round(1).tolist()) for i in range(300)]
    rows += [(500, rows[7][1]), (501, rows[7][1]), (501, rows[7][1]), (500, rows[9][1]), (502, None),
             (503, [1.0, None] * 4), (504, [float("nan")] * 8), (505, [float("inf")] * 8), (None, [1.0] * 8),
             (506, [0.0] * 8), (507, [0.5, 0.25]), (-10, [100.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for table in (df, clashing(df)):
        got = topk.top_products(table, modulus=10, k=5, block_queries=block)
        assert sorted(map(tuple, got.collect())) == brute(rows, 10, 5)
    few = df.where("vec_id < 3")
    assert sorted(map(tuple, topk.top_products(few, 2, 10).collect())) == brute(rows[:3] + rows[-1:], 2, 10)
    assert topk.top_products(df.limit(0)).count() == 0
    assert topk.top_products(df.where("vec_id = 1")).count() == 0


@pytest.mark.parametrize("name", queries.SQL)
def test_query_and_sql(spark, small, name):
    result = difference(spark, oracle_connection(small), small, name)
    assert result == "" or result.startswith("kinds {'refers_to'")


def test_queries_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= registry.queries().keys()
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline(spark, small, documents):
    from tallyloom.llm import decontamination, language_id, simhash
    docs, kept = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, small), name)
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name != "shard":
            assert docs.columns == documents.columns
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        if name == "near_duplicates":
            groups = simhash.near_duplicates(before).collect()
            assert kept[-1] == {r.component_id for r in groups} and docs.count() == len(kept[-1])
        if name == "decontaminate":
            found = decontamination.contained_items(before, spark.read.parquet(f"{small}/benchmark.parquet"))
            assert kept[-1] == ids - {r.doc_id for r in found.collect()} and kept[-1] < ids
        if name == "mix_sources":
            counts = [r["count"] for r in docs.groupBy("doc_id").count().collect()]
            assert kept[-1] < ids and 1 <= max(counts) <= 3
    assert len(kept[0]) == documents.count()
    assert docs.count() == before.count() and docs.where("shard between 0 and 23").count() == docs.count()
    assert language_id.UNDETERMINED == "und"


def test_pipeline_on_messy_rows(spark, messy, empty, clashing, small):
    for start in (messy, empty, clashing(messy)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, small), name)
        if start is empty:
            assert docs.count() == 0
        else:
            assert docs.count() >= 5


def test_pipeline_keeps_columns_of_any_name(spark, documents, small):
    names = ["_key", "_times", "_TIME", "__key", "stays", "n", "excess_bits", "lang_pred"]
    docs = documents.select("*", *(F.concat(F.lit(name), F.col("doc_id")).alias(name) for name in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, small), name)
        assert docs.columns == [*documents.columns, *names]
        wrong = [F.col(column) != F.concat(F.lit(column), F.col("doc_id")) for column in names]
        assert docs.count() > 0 and docs.where(F.greatest(*wrong)).count() == 0


def test_language_stage_rejects_what_no_language_explains(spark, documents, small):
    rng = random.Random(5)
    noise = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    rejects = ["", "123 456", noise("qwzxjkvbp y", 400), noise("абвгдежзиклмнопрст ", 300),
               noise("abcdefghijklmnopqrstuvwxyz ", 20_000), "漢字" * 100, None]
    short = ["ok", "Xyzzy", "Ångström", "Qwq Ltd"]
    rows = [(10**6 + i, t) for i, t in enumerate(rejects + short)]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.language(spark, documents.unionByName(planted, allowMissingColumns=True), small)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {r.doc_id for r in documents.select("doc_id").collect()} | {
        10**6 + len(rejects) + i for i in range(len(short))}
    unlabelled = planted.withColumns({c: F.lit(None).cast("string") for c in ("lang", "source")})
    kept = corpus_pipeline.language(spark, unlabelled, small)
    assert {r.text for r in kept.collect()} == {t for t in rejects[2:] + short if t}
