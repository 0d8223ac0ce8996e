import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.measures import pmi
from tallyloom.operators import cooccurrence as co
from tallyloom.plans import lookups
from tallyloom.sources.text import lines_of


def lines_frame(spark, lines):
    rows = [(i, line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "doc_id bigint, line string")


def brute_pairs(lines, least):
    counts = Counter()
    for line in lines:
        found = set(line.split())
        counts.update((x, y) for x in found for y in found if x != y)
    return {pair: n for pair, n in counts.items() if n >= least}


def brute_pmi(lines, least, total):
    marginals = Counter(w for line in lines for w in set(line.split()))
    n = sum(c for c in marginals.values() if total == "all" or c >= least)
    return {
        (x, y): math.log10(c * n / (marginals[x] * marginals[y]))
        for (x, y), c in brute_pairs(lines, least).items()
    }


@pytest.fixture(scope="module")
def random_lines():
    chance = random.Random(7)
    vocabulary = ["*", "(a", "b,c", "k=v", "é"] + [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [" ".join(chance.choices(vocabulary, weights, k=chance.randint(0, 30))) for _ in range(120)]


def as_dict(frame):
    return {(r[0], r[1]): r[2] for r in frame.collect()}


def test_threshold_counts_lines(spark):
    lines = ["a b a b"] * 9 + ["a c"] * 10 + ["", "d"]
    assert as_dict(co.pair_counts(lines_frame(spark, lines))) == {("a", "c"): 10, ("c", "a"): 10}


def test_pairs_equal_brute_force(spark, random_lines):
    frame = lines_frame(spark, random_lines)
    assert as_dict(co.pair_counts(frame, min_count=3)) == brute_pairs(random_lines, 3)


@pytest.mark.parametrize("block", [1, 3])
def test_long_lines_are_paired_in_blocks(spark, random_lines, monkeypatch, block):
    monkeypatch.setattr(co, "BLOCK_TOKENS", block)
    frame = lines_frame(spark, random_lines)
    assert as_dict(co.pair_counts(frame, min_count=3)) == brute_pairs(random_lines, 3)


@pytest.mark.parametrize("head, first, block", [(0, -32768, 256), (5, -6, 256), (7, -4, 3), (1000, -32768, 2)])
def test_pairs_of_heads_and_of_short_and_long_ids(spark, random_lines, monkeypatch, head, first, block):
    for name, value in (("HEAD_TOKENS", head), ("FIRST_ID", first), ("SHORT_IDS", max(0, -first)), ("BLOCK_TOKENS", block)):
        monkeypatch.setattr(co, name, value)
    monkeypatch.setattr(co, "PAIRS_COUNTED", 1000)
    frame = lines_frame(spark, random_lines)
    assert as_dict(co.pair_counts(frame, min_count=3)) == brute_pairs(random_lines, 3)
    rows = co.stripes(frame, min_count=3, entries=4).collect()
    assert {(r.x, y): n for r in rows for y, n in r.stripe.items()} == brute_pairs(random_lines, 3)


def test_a_pair_travels_as_one_small_number(spark):
    """A line sends an array for each token, and only to its rarer tokens."""
    lines = [" ".join(f"w{i}" for i in range(k)) for k in range(1, 101)]
    frame = lines_frame(spark, lines)
    vocabulary = co.Vocabulary(frame, min_count=1)
    ids = {r.w: r.wid for r in vocabulary.words.collect()}
    assert [ids[f"w{i}"] for i in range(100)] == list(range(100))
    owned = co._owned_ids(co._numbered(frame, "line"), vocabulary, 3)
    assert dict(owned.dtypes)["_near"] == "array<smallint>" and owned.where("_far is not null").count() == 0
    assert owned.count() == sum(k - 1 for k in range(1, 101))
    assert owned.where("array_max(_near) >= _owner").count() == 0
    assert owned.selectExpr("sum(size(_near))").first()[0] == sum(k * (k - 1) // 2 for k in range(1, 101))


@pytest.mark.parametrize("total", ["frequent", "all"])
@pytest.mark.parametrize("form", [co.pmi_pairs, co.pmi_stripes])
def test_pmi_equals_brute_force(spark, random_lines, form, total):
    found = as_dict(form(lines_frame(spark, random_lines), min_count=4, total=total))
    expected = brute_pmi(random_lines, 4, total)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], abs_tol=1e-12) for k in expected)
    assert all(found[x, y] == found[y, x] for x, y in found)


def test_pmi_without_any_broadcast_table(spark, random_lines, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookups, "HEAVY_SHARE", 20)
    found = as_dict(co.pmi_pairs(lines_frame(spark, random_lines), min_count=4))
    expected = brute_pmi(random_lines, 4, "frequent")
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], abs_tol=1e-12) for k in expected)


def test_anchored_pmi_is_the_part_of_all_pmi(spark, random_lines):
    frame = lines_frame(spark, random_lines)
    anchors = ["*", "w3", "absent"]
    every = as_dict(co.pmi_pairs(frame, min_count=3))
    some = as_dict(co.pmi_of_anchors(frame, anchors, min_count=3))
    assert some == {k: v for k, v in every.items() if k[0] in anchors} and some


def test_pair_total(spark, random_lines):
    frame = lines_frame(spark, random_lines)
    assert co.pair_total(frame, min_count=3).first()[0] == len(brute_pairs(random_lines, 3))


@pytest.mark.parametrize("entries", [65536, 4])
def test_stripes_hold_the_pairs(spark, random_lines, entries):
    table = co.stripes(lines_frame(spark, random_lines), min_count=3, entries=entries)
    rows = table.collect()
    found = {(r.x, y): n for r in rows for y, n in r.stripe.items()}
    expected = brute_pairs(random_lines, 3)
    assert found == expected
    assert len(found) == sum(len(r.stripe) for r in rows)
    assert (max(r.part for r in rows) > 0) == (entries == 4)


def test_large_counts_do_not_overflow(spark):
    big = 2**31 - 1
    row = spark.createDataFrame([(big, big, big, big)], "a bigint, b bigint, c bigint, d bigint")
    assert row.select(pmi(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0] == 0.0


def test_top_neighbours_rank_and_break_ties_by_word(spark):
    scores = spark.createDataFrame(
        [("x", "a", 1.0), ("x", "b", 2.0), ("x", "c", 3.0), ("x", "e", 2.0), ("z", "a", 3.0)],
        "x string, y string, pmi double",
    )
    top = [(r.x, r.y, r["rank"]) for r in co.top_neighbours(scores, 3).collect()]
    assert sorted(top) == [("x", "b", 2), ("x", "c", 1), ("x", "e", 3), ("z", "a", 1)]
    assert tuple(co.greatest_pmi(scores).first()) == ("x", "c", 3.0)


@pytest.mark.parametrize("total", ["frequent", "all"])
@pytest.mark.parametrize("least", [1, 3, 10])
def test_the_greatest_pmi_by_bounds_is_that_of_all_pairs(spark, random_lines, least, total):
    frame = lines_frame(spark, random_lines)
    scores = co.pmi_pairs(frame, min_count=least, total=total)
    report = []
    found = co.greatest_pmi_pair(frame, min_count=least, total=total, report=report)
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in co.greatest_pmi(scores).collect()]
    assert report[0][0] == 2 * least


def test_the_greatest_pmi_pairs_few_words(spark):
    # Two rare words that always meet, among many frequent ones.
    lines = [f"w{i % 30} w{i % 29} w{i % 23} w{i % 19}" for i in range(3000)] + ["left right w1"] * 12
    frame, report = lines_frame(spark, lines), []
    found = co.greatest_pmi_pair(frame, report=report)
    assert tuple(found.select("x", "y").first()) == ("left", "right")
    assert report == [(20, 2, 24)]
    assert co.Vocabulary(frame).pairs_met() > 15_000
    # No pair is frequent: every word is tried, and nothing is found.
    lonely, report = lines_frame(spark, [f"a{i} b{i % 7}" for i in range(100)]), []
    assert co.greatest_pmi_pair(lonely, report=report).count() == 0 and report
    assert co.greatest_pmi_pair(lonely.limit(0)).count() == 0


def test_many_best_of_a_large_group(spark):
    scores = spark.range(5000).selectExpr("'x' as x", "cast(id as string) as y", "id % 700 * 1.0D as pmi")
    top = co.top_neighbours(scores, 1500).orderBy("rank").collect()
    rows = sorted(scores.collect(), key=lambda r: (-r.pmi, r.y))[:1500]
    assert [(r["rank"], r.y) for r in top] == [(i, r.y) for i, r in enumerate(rows, 1)]


def test_unknown_total_is_refused(spark):
    with pytest.raises(ValueError):
        co.pmi_pairs(lines_frame(spark, ["a b"]), total="some")


def test_no_frequent_token_gives_no_rows(spark):
    frame = lines_frame(spark, ["a b", "c"])
    assert co.pmi_pairs(frame).count() == 0
    assert co.pmi_stripes(frame).count() == 0


def test_no_line_gives_no_rows(spark):
    lines = spark.createDataFrame([("a b",)], "line string")
    for empty in (spark.createDataFrame([], "doc_id bigint, line string"),
                  lines.where("1 = 0"), lines.where("line = 'x'")):
        assert co.pair_counts(empty).count() == 0
        assert co.pmi_pairs(empty).count() == 0


def test_the_number_of_pairs_to_come_is_known(spark):
    frame = lines_frame(spark, ["a b c a", "d", "", "a b"])
    assert co.Vocabulary(frame, min_count=1).pairs_met() == 4
    assert co.Vocabulary(frame, min_count=2, total="all").pairs_met() == 3


def test_lines_of_keeps_blank_lines(spark):
    documents = spark.createDataFrame([(5, "a\n\nb")], "doc_id bigint, text string")
    assert [tuple(r) for r in lines_of(documents).collect()] == [(5, 0, "a"), (5, 1, ""), (5, 2, "b")]


def test_lines_need_no_key(spark):
    """Keyless lines, one key for all and repeated lines all count line by line."""
    texts = ["a c"] * 10 + ["b d"] * 10
    bare = spark.createDataFrame([(t,) for t in texts], "line string")
    for lines in (bare, bare.selectExpr("7 AS doc_id", "line"), bare.repartition(5)):
        found = {tuple(r) for r in co.pair_counts(lines).collect()}
        assert found == {("a", "c", 10), ("c", "a", 10), ("b", "d", 10), ("d", "b", 10)}
        assert co.pair_counts(lines).count() == 4
