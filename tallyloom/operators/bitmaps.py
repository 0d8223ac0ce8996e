"""Boolean retrieval on bitmaps: one for each term and block of documents.

Postings become bits where they are read, so the one shuffle carries a bitmap of four
kilobytes for each term and block, never a row for a posting. All queries of a batch are
answered from a block's bitmaps, word by word, in its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import postfix_fold, query_terms
from tallyloom.operators.ordinals import BLOCK_DOCS
from tallyloom.sources.sinks import stored_terms

WORD_BITS = 32


def term_bitmaps(postings: DataFrame, terms: list[str]) -> DataFrame:
    """(block, bitmap_0, bitmap_1, ...) of postings (term, ordinal): a bitmap for each of the terms."""
    place = F.col("ordinal") + 1
    bits = postings.select(
        "term", (F.bitmap_bucket_number(place) - 1).alias("block"), F.bitmap_bit_position(place).alias("bit"))
    return bits.groupBy("block").agg(*[
        F.bitmap_construct_agg(F.when(F.col("term") == term, F.col("bit"))).alias(f"bitmap_{i}")
        for i, term in enumerate(terms)])


def _word(bitmap: Column, at: Column) -> Column:
    """Four bytes of a bitmap as a number, the first byte as its highest."""
    size = WORD_BITS // 8
    return F.conv(F.hex(F.substring(bitmap, at * size + 1, F.lit(size))), 16, 10).cast("bigint")


def _set_bits(word: Column) -> Column:
    """The places of the bits of a word in the order of the bitmap."""
    places = [(place, 8 * (WORD_BITS // 8 - 1 - place // 8) + place % 8) for place in range(WORD_BITS)]
    return F.array_compact(F.array(*[
        F.when(word.bitwiseAND(F.lit(1 << shift)) != 0, F.lit(place)) for place, shift in places]))


def boolean_batch(index: DataFrame, queries: dict[str, str]) -> DataFrame:
    """(query_id, ordinal) for postfix AND/OR queries on a stored index by ordinals."""
    terms = query_terms(list(queries.values()))
    postings = stored_terms(index, terms).select("term", F.inline("postings"))
    words = term_bitmaps(postings, terms).select("*", F.explode(F.sequence(
        F.lit(0), F.lit(BLOCK_DOCS // WORD_BITS - 1))).alias("at"))
    words = words.select("block", "at", *[
        _word(F.col(f"bitmap_{i}"), F.col("at")).alias(f"word_{i}") for i in range(len(terms))])
    place = {term: i for i, term in enumerate(terms)}
    answers = F.array(*[F.struct(F.lit(name).alias("query_id"), postfix_fold(
        query, lambda term: F.col(f"word_{place[term]}"), lambda a, b: a.bitwiseAND(b), lambda a, b: a.bitwiseOR(b)
    ).alias("word")) for name, query in queries.items()])
    found = words.select("block", "at", F.inline(answers)).where("word <> 0")
    return found.select("query_id", "block", "at", F.explode(_set_bits(F.col("word"))).alias("bit")).select(
        "query_id", (F.col("block") * BLOCK_DOCS + F.col("at") * WORD_BITS + F.col("bit")).alias("ordinal"))
