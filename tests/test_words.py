import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.text import index_tokens, is_alphabetic, tokens
from tallyloom.operators import words


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "text string").select(*columns).first()


def test_tokens_end_at_every_white_space(spark):
    row = one(spark, " a\tb\nc\rd\fe  f\x0bg ", tokens(F.col("text")), index_tokens(F.col("text")))
    assert row[0] == ["a", "b", "c", "d", "e", "f\x0bg"]
    assert row[1] == ["a", "b", "c", "d", "e", "f", "g"]


def test_no_break_space_and_accents_are_no_breaks(spark):
    assert one(spark, "é b", tokens(F.col("text")))[0] == ["é b"]


def test_alphabetic_is_a_full_match_in_ascii(spark):
    found = spark.createDataFrame(
        [("abc",), ("don't",), ("a1",), ("é",), ("",), ("A\n",), ("abc\x85",), ("abc\u2028",), ("abc\u2029",)], "t string"
    ).select("t", is_alphabetic(F.col("t")).alias("ok"))
    assert {r.t for r in found.collect() if r.ok} == {"abc"}


def test_word_count_and_unique_terms(spark):
    texts = spark.createDataFrame([("the cat the",), ("'tis the",), (None,), ("  ",)], "text string")
    counts = words.word_count(texts)
    assert {tuple(r) for r in counts.collect()} == {("the", 3), ("cat", 1), ("'tis", 1)}
    plain = words.word_count(texts, alphabetic=True)
    assert {tuple(r) for r in plain.collect()} == {("the", 3), ("cat", 1)}
    assert tuple(words.unique_terms(counts).first()) == (3, 5)


def test_term_at_counts_from_both_ends(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 1), ("é", 4), ("z", 3)], "term string, n bigint")
    assert words.term_at(counts, 1).first().term == "a"
    assert words.term_at(counts, 2, from_end=True).first().term == "z"
    assert words.term_at(counts, 9).count() == 0


def test_line_tokens_are_distinct_per_line(spark):
    lines = spark.createDataFrame([(1, 0, "a b a"), (1, 1, ""), (2, 0, "a *")],
                                  "doc_id bigint, line_no int, line string")
    found = sorted(tuple(r) for r in words.line_tokens(lines).collect())
    assert found == [(1, 0, "a"), (1, 0, "b"), (2, 0, "*"), (2, 0, "a")]


def test_terms_at_any_position_of_each_kind(spark):
    chance = random.Random(4)
    terms = sorted({"".join(chance.choice("abÀz1-") for _ in range(chance.randint(1, 6))) for _ in range(3000)},
                   key=lambda t: t.encode())
    rows = [(t, i) for i, t in enumerate(terms)]
    chance.shuffle(rows)
    counts = words.with_kinds(spark.createDataFrame(rows, "term string, n bigint").repartition(5))
    kinds = {"all": terms, "alphabetic": [t for t in terms if t.isascii() and t.isalpha()]}
    size = len(terms)
    positions = [1, 2, 77, size // 2, size, size + 1, -1, -2, -900, -size, -size - 1]
    found = {(r.kind, r.position): (r.term, r.n) for r in words.terms_at(counts, positions).collect()}
    expected = {}
    for kind, held in kinds.items():
        for p in positions:
            at = p - 1 if p > 0 else len(held) + p
            if 0 <= at < len(held):
                expected[kind, p] = (held[at], terms.index(held[at]))
    assert found == expected
    assert words.terms_at(counts.limit(0), [1, -1]).count() == 0
    assert words.terms_at(counts, []).count() == 0
    with pytest.raises(ValueError):
        words.terms_at(counts, [0])


def test_unique_terms_of_both_kinds_in_one_pass(spark):
    counts = spark.createDataFrame([("a", 3), ("b1", 2), (None, 1)], "term string, n bigint")
    assert sorted(tuple(r) for r in words.unique_terms_of_kinds(counts.where("term is not null")).collect()) == [
        ("all", 2, 5), ("alphabetic", 1, 3)]
    assert sorted(tuple(r) for r in words.unique_terms_of_kinds(counts.limit(0)).collect()) == [
        ("all", 0, 0), ("alphabetic", 0, 0)]
