import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import postings as po
from tallyloom.operators import retrieval as re
from tallyloom.sources import sinks
from tallyloom.sources.text import read_documents


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(3)
    ids = [9, 10, 100, 2**33] + [chance.randrange(10**6) for _ in range(60)]
    words = [f"w{i}" for i in range(25)]
    weights = [1 / (i + 1) for i in range(25)]
    return {i: " ".join(chance.choices(words, weights, k=chance.randint(0, 25))) for i in set(ids)}


@pytest.fixture(scope="module")
def documents(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")


@pytest.fixture(scope="module")
def expected(texts):
    return {(t, i): n for i, text in texts.items() for t, n in Counter(text.split()).items()}


def as_dict(rows):
    found = [(r.term, r.doc_id, r.tf) for r in rows.collect()]
    assert len(found) == len({f[:2] for f in found})
    return {(t, i): n for t, i, n in found}


def test_frequencies(documents, expected):
    assert as_dict(po.term_frequencies(documents)) == expected


def test_empty_and_missing_texts_have_no_postings(spark):
    bare = spark.createDataFrame([(1, ""), (2, None), (3, " \t")], "doc_id bigint, text string")
    assert po.term_frequencies(bare).count() == 0


def test_collection_and_document_frequency_differ(documents, expected):
    for row in po.term_stats(po.term_frequencies(documents)).collect():
        of_term = [n for (t, _), n in expected.items() if t == row.term]
        assert (row.cf, row.df) == (sum(of_term), len(of_term))


@pytest.mark.parametrize("block", [po.BLOCK_DOCS, 7])
def test_blocks_in_order_are_the_postings_list(documents, expected, block):
    index = po.inverted_index(po.term_frequencies(documents), block)
    lists = {}
    for row in index.orderBy("term", "block").collect():
        assert 0 < len(row.postings) <= block
        assert all(p.doc_id // block == row.block for p in row.postings)
        lists.setdefault(row.term, []).extend((p.doc_id, p.tf) for p in row.postings)
    assert all(found == sorted(found) for found in lists.values())
    assert {(t, i): n for t, found in lists.items() for i, n in found} == expected


@pytest.mark.parametrize("block, stretch", [(po.BLOCK_DOCS, po.STRETCH_BLOCKS), (7, 5), (1000, 40)])
def test_gaps_run_over_all_blocks_and_decode(documents, expected, monkeypatch, block, stretch):
    monkeypatch.setattr(po, "STRETCH_BLOCKS", stretch)
    gaps = po.gap_index(po.inverted_index(po.term_frequencies(documents), block))
    running = {}
    for row in gaps.orderBy("term", "block").collect():
        for cell in row.gaps:
            assert cell.gap >= 0
            at = running.get(row.term, 0) + cell.gap
            running[row.term] = at
            assert expected[row.term, at] == cell.tf
    assert as_dict(po.from_gaps(gaps)) == expected


def test_wide_rows_hold_the_postings(documents, expected):
    index = po.inverted_index(po.term_frequencies(documents), 1000)
    assert as_dict(po.postings_of(po.wide_rows(index))) == expected
    assert as_dict(po.postings_of(index)) == expected


@pytest.mark.parametrize("kind", ["bigint", "int"])
@pytest.mark.parametrize("block", [po.BLOCK_DOCS, 7])
def test_postings_of_any_ids_and_counts_are_kept(spark, kind, block):
    """Negative, missing and extreme ids, and counts that do not fit into a packed number."""
    most = 2**63 - 1 if kind == "bigint" else 2**31 - 1
    ids = [None, -most - 1, -9, -7, -1, 0, 6, 7, 65536, most]
    rows = [(term, i, tf) for term in "ab" for i in ids for tf in [(len(str(i)), most, None, -1)[len(term + str(i)) % 4]]]
    frequencies = spark.createDataFrame(rows, f"term string, doc_id {kind}, tf {kind}")
    index = po.inverted_index(frequencies, block)
    assert dict(index.dtypes)["postings"] == f"array<struct<doc_id:{kind},tf:{kind}>>"
    lists = [row.postings for row in index.collect()]
    assert sorted(map(str, rows)) == sorted(str((r.term, *p)) for r in index.collect() for p in r.postings)
    assert all([p.doc_id for p in found] == sorted((p.doc_id for p in found), key=lambda i: (i is not None, i or 0))
               for found in lists)


def test_wide_rows_make_small_and_large_maps_apart(documents, expected, monkeypatch):
    monkeypatch.setattr(po, "SMALL_MAP", 2)
    index = po.inverted_index(po.term_frequencies(documents), 1000)
    rows = po.wide_rows(index)
    assert as_dict(po.postings_of(rows)) == expected
    sizes = [len(r.cells) for r in rows.collect()]
    assert min(sizes) <= 2 < max(sizes)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "map_from_arrays" in plan and "map_from_entries" in plan


def test_gaps_and_layout_make_the_index_once(documents):
    index = po.inverted_index(po.term_frequencies(documents), 1000)
    for coded in (po.gap_index(index), po.from_gaps(po.gap_index(index))):
        assert "collect_list" not in coded._jdf.queryExecution().executedPlan().toString()
    # A range partition would be sampled first, for which its rows are made as well.
    assert "rangepartitioning" not in sinks._laid_out(index, 4)._jdf.queryExecution().executedPlan().toString()


def test_tf_histogram(documents, expected):
    found = {(r.term, r.tf): r.n_docs for r in po.tf_histogram(po.term_frequencies(documents), ["w0", "w9"]).collect()}
    assert found == Counter((t, n) for (t, _), n in expected.items() if t in ("w0", "w9"))


@pytest.fixture(scope="module")
def stored(spark, documents, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "index")
    sinks.write_index(po.inverted_index(po.term_frequencies(documents), 1000), path, shards=4)
    return sinks.read_index(spark, path)


def test_stored_index_reads_the_shards_of_the_terms(stored, expected):
    found = sinks.stored_terms(stored, ["w0", "w3", "absent"])
    assert as_dict(po.postings_of(found)) == {k: n for k, n in expected.items() if k[0] in ("w0", "w3")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan and "In(term" in plan
    assert sinks.stored_terms(stored, []).count() == 0


def test_a_heavy_term_spans_several_partitions(spark):
    frequencies = spark.range(4000).select(
        F.lit("hot").alias("term"), F.col("id").alias("doc_id"), F.lit(1).alias("tf")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        laid_out = sinks._laid_out(po.inverted_index(frequencies, 10), 4)
        sizes = laid_out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 100


def test_index_table_replaces_an_earlier_one(spark, documents, expected):
    table = "keyed_postings"
    wide = po.wide_rows(po.inverted_index(po.term_frequencies(documents), 1000))
    try:
        sinks.save_index_table(wide.limit(1), table, shards=4)
        sinks.save_index_table(wide, table, shards=4)
        found = sinks.stored_terms(spark.table(table), ["w1"])
        assert as_dict(po.postings_of(found)) == {k: n for k, n in expected.items() if k[0] == "w1"}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


# Retrieval

BATCH = {
    "a": "w20 w21 OR w5 AND w3 AND",
    "b": "w10 w5 AND",
    "c": "w0",
    "d": "absent w0 AND",
    "e": "absent w12 OR",
    "f": "w8 w9 AND w10 w11 AND OR w0 OR",
}


def brute(texts, query):
    stack = []
    for word in query.split():
        if word in ("AND", "OR"):
            right, left = stack.pop(), stack.pop()
            stack.append(left & right if word == "AND" else left | right)
        else:
            stack.append({i for i, text in texts.items() if word in text.split()})
    return stack.pop()


def test_batch_equals_brute_force(documents, texts):
    rows = re.boolean_batch(po.term_frequencies(documents), BATCH).collect()
    found = {}
    for row in rows:
        found.setdefault(row.query_id, []).append(row.doc_id)
    for name, query in BATCH.items():
        assert sorted(found.get(name, [])) == sorted(brute(texts, query)), name


def test_and_is_within_each_operand_and_or_holds_both(documents):
    frequencies = po.term_frequencies(documents)
    ids = lambda frame: {r.doc_id for r in frame.collect()}
    left, right = ids(re.boolean_query(frequencies, "w2")), ids(re.boolean_query(frequencies, "w4"))
    assert ids(re.boolean_and(frequencies, "w2", "w4")) == left & right
    assert ids(re.boolean_or(frequencies, "w2", "w4")) == left | right


def test_a_stored_index_answers_the_same(stored, documents):
    terms = ["w2", "w4"]
    from_store = re.boolean_and(po.postings_of(sinks.stored_terms(stored, terms)), *terms)
    assert sorted(from_store.collect()) == sorted(re.boolean_and(po.term_frequencies(documents), *terms).collect())


@pytest.mark.parametrize("query", ["", "AND", "a AND", "a OR b"])
def test_a_malformed_query_is_refused(documents, query):
    with pytest.raises(ValueError):
        re.boolean_query(po.term_frequencies(documents), query)


def test_missing_terms(documents):
    found = re.missing_terms(po.term_frequencies(documents), ["w0", "absent", "absent", "w1"])
    assert [r.term for r in found.collect()] == ["absent"]


def test_retrieval_over_several_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y\n")
    (tmp_path / "b.txt").write_text("z w\nx z\n")
    documents = read_documents(spark, str(tmp_path))
    frequencies = po.term_frequencies(documents)
    hits = re.boolean_and(frequencies, "x", "z")
    assert [r.text for r in re.fetch(hits, documents).collect()] == ["x z"]
    found = re.fetch(re.boolean_query(frequencies, "x"), documents)
    assert sorted(r.text for r in found.collect()) == ["x y", "x z"]
    cells = po.postings_of(po.wide_rows(po.inverted_index(frequencies))).where("term = 'x'")
    assert cells.count() == 2


def test_texts_of_few_hits_are_not_shuffled(spark, documents):
    hits = re.boolean_query(po.term_frequencies(documents), "w20")
    plan = re.fetch(hits, documents)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_fetch_and_preview(spark):
    documents = spark.createDataFrame([(1, "x" * 100), (2, "short é")], "doc_id bigint, text string")
    hits = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    assert {r.doc_id: r.text for r in re.fetch(hits, documents).collect()} == {1: "x" * 100, 2: "short é"}
    cut = {r.doc_id: r.preview for r in re.fetch_preview(hits, documents).collect()}
    assert cut == {1: "x" * 80, 2: "short é"}
