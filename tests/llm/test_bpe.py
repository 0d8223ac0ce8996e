import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                             special_tokens={})


def coded(df):
    return bpe.encode_and_decode(df, PATH, public_tokenizers.PATTERN).collect()


def expected(rows, library):
    return sorted((repr(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)


def as_rows(found):
    return sorted((repr(r.doc_id), np.frombuffer(r.code, "<u4").tolist(), bytes(r.decoded)) for r in found)


def test_whole_texts_as_the_library_has_them(documents, library):
    found = coded(documents)
    assert as_rows(found) == expected(documents.select("doc_id", "text").collect(), library)
    assert all(r.n_tokens == len(r.code) // 4 for r in found)


def test_nulls_repeats_specials_and_clashing_names(messy, empty, clashing, library):
    assert as_rows(coded(clashing(messy))) == expected(messy.select("doc_id", "text").collect(), library)
    assert coded(empty) == []


def test_every_class_of_characters(spark, library):
    """Runs of all characters, those that a Java of an older Unicode lacks among them."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, points[i:i + 4096])) for i in range(0, len(points), 4096 * 40)]
    texts += ["".join(chr(c) + " a1" for c in (0x870, 0x1C89, 0x2EBF0, 0x10D40, 0x1E5F1, 0x85, 0xA0, 0x3000, 0x180E))]
    rows = list(enumerate(texts))
    assert as_rows(coded(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows, library)


def test_long_words_and_runs(spark, library):
    draw = random.Random(5)
    texts = ["=" * 3000, " " * 2999 + "x", "a" * 1001, "ab" * 700, "7" * 500, "é" * 300]
    texts += ["".join(draw.choice("abcde漢字é") for _ in range(n)) for n in (31, 33, 95, 96, 97, 98, 1500)]
    rows = list(enumerate(texts))
    assert as_rows(coded(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows, library)


def test_any_ranks(spark, tmp_path):
    """Rank files that no training made, where a merge can make a pair of lower rank."""
    import base64
    draw = random.Random(3)
    tokens = [bytes([i]) for i in range(256)]
    tokens += list({"".join(draw.choice("abc") for _ in range(draw.randint(2, 6))).encode() for _ in range(60)})
    ranks = list(range(len(tokens)))
    draw.shuffle(ranks)
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in zip(tokens, ranks)))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(zip(tokens, ranks)),
                            special_tokens={})
    rows = [(n, "".join(draw.choice("abc") for _ in range(n))) for n in [*range(1, 60), 97, 150, 400]]
    found = bpe.encode_and_decode(spark.createDataFrame(rows, "doc_id long, text string"), str(path),
                                  public_tokenizers.PATTERN).collect()
    assert as_rows(found) == expected(rows, own)


def test_words_beyond_the_table_are_folded(spark, documents, library, monkeypatch):
    monkeypatch.setattr(bpe, "frequent_words", lambda texts, vocabulary, **_: texts.sparkSession.createDataFrame(
        [], "word string, code binary"))
    few = documents.where(F.length("text") < 2000)
    assert as_rows(coded(few)) == expected(few.select("doc_id", "text").collect(), library)


@pytest.mark.parametrize("case", ["few", "many", "whole"])
def test_pairs_join_to_the_token_of_both(case):
    """The table has each pair that joins to a token, and no other."""
    ranks = {bytes([i]): i for i in range(256)}
    if case == "few":
        ranks |= {b"ab": 70000, b"abc": 256, b"bc": 69999}
    elif case == "many":
        ranks |= {bytes([a, b]): 1000 + 256 * a + b for a in (0, 97, 255) for b in range(256)}
    else:
        ranks = bpe.read_ranks(PATH)
    offsets, entries, bits = bpe.pair_table(ranks)
    found = {(e >> bits, place - offsets[e >> bits]): e & (1 << bits) - 1
             for place, e in enumerate(entries) if e is not None}
    tokens = {rank: token for token, rank in ranks.items()}
    assert all(tokens[a] + tokens[b] == tokens[rank] for (a, b), rank in found.items())
    splits = [(t[:i], t[i:]) for t in ranks for i in range(1, len(t))]
    assert set(found) == {(ranks[a], ranks[b]) for a, b in splits if a in ranks and b in ranks}


def test_only_tokens_that_merging_misses_are_looked_up(spark, tmp_path):
    """A plan mentions no literal map of all tokens."""
    import base64
    assert bpe.Vocabulary(spark, PATH, public_tokenizers.PATTERN).whole is None
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"xyz": 257}
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
    vocabulary = bpe.Vocabulary(spark, str(path), public_tokenizers.PATTERN)
    words = spark.createDataFrame([("ab",), ("xyz",), ("xyza",), ("aab",)], "word string")
    found = words.select(bpe.fold(F.col("word"), vocabulary).alias("ids")).collect()
    assert [row.ids for row in found] == [[256], [257], [120, 121, 122, 97], [97, 256]]
