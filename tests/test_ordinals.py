import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import bitmaps, ordinals, postings
from tallyloom.plans import workload
from tallyloom.sources import sinks


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("ids", [
    [n * 7919 % 100_003 - 50_000 for n in range(500)], [hash(("x", n)) for n in range(500)],
    [n * n * 37 for n in range(500)], [None, -2**63, 2**63 - 1, 0], []])
def test_ordinals_are_dense_and_in_order_of_the_ids(spark, ids):
    rows = spark.createDataFrame([(i, "x") for i in ids], "id bigint, text string").repartition(7)
    found = ordinals.with_ordinals(rows, "id").select("id", "ordinal").collect()
    wanted = sorted(ids, key=lambda i: (i is not None, i or 0))
    assert sorted(((r[1], r[0]) for r in found), key=lambda r: r[0]) == list(enumerate(wanted))


def test_a_term_has_as_few_rows_as_its_documents_allow(spark):
    docs = spark.createDataFrame([(n * 2654435761 % 2**40 - 2**39, f"all {'some' if n % 3 else 'few'}")
                                  for n in range(1000)], "doc_id bigint, text string")
    frequencies = postings.term_frequencies(ordinals.with_ordinals(docs, "doc_id"), besides=("ordinal",))
    index = postings.ordinal_index(frequencies, block_docs=64)
    rows = {r["term"]: r["n"] for r in index.groupBy("term").agg(F.count("*").alias("n")).collect()}
    assert rows["all"] == math.ceil(1000 / 64)
    assert max(rows.values()) <= math.ceil(1000 / 64)
    assert sorted(map(tuple, postings.postings_of(index).collect())) == sorted(
        map(tuple, frequencies.select("term", "doc_id", "tf").collect()))


@pytest.fixture(scope="module")
def sparse(spark, tmp_path_factory):
    """Postings over several blocks of ordinals, with the borders of blocks, words and bytes."""
    draw = random.Random(1)
    edges = [0, 7, 8, 31, 32, 32767, 32768, 65535, 65536, 100_000]
    lists = {t: sorted(set(draw.sample(range(100_000), n)) | set(draw.sample(edges, 5)))
             for t, n in {"a": 900, "b": 4000, "c": 40, "d": 1}.items()}
    rows = [(t, o, o * 3, 1) for t, held in lists.items() for o in held]
    frequencies = spark.createDataFrame(rows, "term string, ordinal bigint, doc_id bigint, tf bigint")
    folder = str(tmp_path_factory.mktemp("index"))
    sinks.write_index(postings.ordinal_index(frequencies), folder)
    return sinks.read_index(spark, folder), {t: set(held) for t, held in lists.items()}


def test_postings_are_stored_as_an_index_would_be(spark, tmp_path):
    """The same rows in the same shards, with one shuffle, and no task for a whole frequent term."""
    draw = random.Random(2)
    docs = spark.createDataFrame([(n * 31 - 900, " ".join(["all", *draw.choices("abcdefgh", k=n % 5)]))
                                  for n in range(400)], "doc_id bigint, text string")
    frequencies = postings.term_frequencies(ordinals.with_ordinals(docs, "doc_id"), besides=("ordinal",))
    sinks.write_index(postings.ordinal_index(frequencies, block_docs=32), f"{tmp_path}/index")
    sinks.write_postings(frequencies, f"{tmp_path}/once", 400, block_docs=32)
    usual, once = (sinks.read_index(spark, f"{tmp_path}/{name}") for name in ("index", "once"))
    assert usual.dtypes == once.dtypes
    assert sorted(usual.collect()) == sorted(once.collect()) and once.count() > 13
    files = once.where("term = 'all'").select("_metadata.file_path").distinct().count()
    assert files > 4


def test_bitmaps_answer_as_sets_do(sparse):
    index, sets = sparse
    a, b, c, d = (sets[t] for t in "abcd")
    queries = {"and": "a b AND", "or": "a c OR", "mixed": "a b AND c d OR OR", "deep": "a b OR c OR d AND",
               "same": "a a AND", "alone": "d", "absent": "a nowhere AND", "either": "nowhere d OR"}
    wanted = {"and": a & b, "or": a | c, "mixed": (a & b) | c | d, "deep": (a | b | c) & d, "same": a, "alone": d,
              "absent": set(), "either": d}
    found = {name: set() for name in queries}
    rows = bitmaps.boolean_batch(index, queries).collect()
    for row in rows:
        found[row["query_id"]].add(row["ordinal"])
    assert found == wanted
    assert len(rows) == sum(map(len, wanted.values()))
    with pytest.raises(ValueError):
        bitmaps.boolean_batch(index, {"q": "a AND"})


def test_postings_become_bitmaps_before_the_shuffle(spark, sparse):
    index, _ = sparse
    found = bitmaps.boolean_batch(index, {"q": "a b AND"})
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning(block") == 1
    assert "partial_bitmap_construct_agg" in physical.split("Exchange hashpartitioning(block")[1]


def test_hits_open_only_their_blocks(spark, tmp_path):
    docs = spark.range(2000).select((F.col("id") * 5 - 3000).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    ordinals.write_store(docs, str(tmp_path / "store"), block_docs=100)
    store = ordinals.read_store(spark, str(tmp_path / "store"))
    hits = spark.createDataFrame([(3, "q"), (99, "r"), (1500, "q")], "ordinal bigint, query_id string")
    found = ordinals.fetch(hits, store, "doc_id", "text", block_docs=100)
    assert sorted(map(tuple, found.collect())) == [
        (3, "q", -2985, "text 3"), (99, "r", -2505, "text 99"), (1500, "q", 4500, "text 1500")]
    assert "dynamicpruning" in plan_of(found)
    blocks = store.select("ordinal", "_metadata.file_path", "block").groupBy("block").agg(
        F.count_distinct("file_path").alias("files"))
    assert blocks.count() == 20
    assert ordinals.fetch(hits.limit(0), store, "text", block_docs=100).count() == 0


def test_a_replaced_table_or_a_cleaned_folder_is_seen(spark, tmp_path):
    def write(text):
        spark.createDataFrame([(1, text), (2, "other")], "doc_id bigint, text string").write.mode("overwrite").parquet(
            str(tmp_path / "documents.parquet"))

    def found():
        return sorted(tuple(r) for r in workload.postings_lookup(spark, str(tmp_path)).collect())

    write("the old the")
    assert found() == [("the", 1, 2)]
    first = workload._stored(spark, str(tmp_path))
    assert workload._stored(spark, str(tmp_path)) == first
    write("now the new")
    assert found() == [("the", 1, 1)]
    folder = workload._stored(spark, str(tmp_path))
    assert folder != first
    workload._STORED.update({k: folder + "-gone" for k, v in workload._STORED.items() if v == folder})
    assert found() == [("the", 1, 1)]


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_documents_are_numbered_without_writing_their_texts(spark, monkeypatch, limit):
    from tallyloom.plans import lookups, storage
    written, write = [], storage.write_and_read
    monkeypatch.setattr(storage, "write_and_read", lambda df, folder: written.append(df.columns) or write(df, folder))
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", limit)
    docs = spark.createDataFrame([(n * 37 % 101 - 50, f"t{n}") for n in range(101)], "doc_id bigint, text string")
    found = workload._numbered_in_place(docs, "doc_id").select("doc_id", "text", "ordinal").collect()
    assert sorted(tuple(r) for r in found) == sorted((d, t, d + 50) for d, t in docs.collect())
    assert written and not any("text" in columns for columns in written)
