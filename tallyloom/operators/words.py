"""Word counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import distinct_tokens, is_alphabetic, tokens
from tallyloom.operators.ordinals import with_ordinals
from tallyloom.plans.lookups import fits_broadcast
from tallyloom.plans.storage import materialize


def tokens_per_document(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return documents.select(key, F.size(tokens(F.col(text))).cast("bigint").alias("n_tokens"))


def line_tokens(lines: DataFrame, text: str = "line") -> DataFrame:
    """Every distinct token of every line: the key columns and ``token``."""
    keys = [c for c in lines.columns if c != text]
    return lines.select(*keys, F.explode(distinct_tokens(F.col(text))).alias("token"))


def word_count(texts: DataFrame, text: str = "text", alphabetic: bool = False) -> DataFrame:
    """(term, n) over all tokens, or over purely alphabetic ones."""
    words = texts.select(F.explode(tokens(F.col(text))).alias("term"))
    if alphabetic:
        words = words.where(is_alphabetic(F.col("term")))
    return words.groupBy("term").agg(F.count("*").alias("n"))


def unique_terms(counts: DataFrame) -> DataFrame:
    """Number of terms and of their occurrences in a (term, n) table."""
    return counts.agg(
        F.count("*").alias("n_terms"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_tokens")
    )


def with_kinds(counts: DataFrame) -> DataFrame:
    """(kind, term, n): every term as ``all``, the purely alphabetic ones as ``alphabetic`` too."""
    kinds = F.when(
        is_alphabetic(F.col("term")), F.array(F.lit("all"), F.lit("alphabetic"))
    ).otherwise(F.array(F.lit("all")))
    return counts.select(F.explode(kinds).alias("kind"), "term", "n")


def unique_terms_of_kinds(counts: DataFrame) -> DataFrame:
    """(kind, n_terms, n_tokens) for all and for alphabetic terms, in one pass over (term, n)."""
    plain = is_alphabetic(F.col("term"))
    sums = {
        "all": (F.count("*"), F.sum("n")),
        "alphabetic": (F.count_if(plain), F.sum(F.when(plain, F.col("n")))),
    }
    rows = counts.agg(F.array(*[
        F.struct(F.lit(kind).alias("kind"), terms.alias("n_terms"),
                 F.coalesce(occurrences, F.lit(0)).alias("n_tokens"))
        for kind, (terms, occurrences) in sums.items()
    ]).alias("rows"))
    return rows.select(F.inline("rows"))


def terms_at(counts: DataFrame, positions: list[int], kind: str = "kind") -> DataFrame:
    """(kind, position, term, n) at any 1-based positions of the sorted terms of each kind.

    Negative positions count from the end. All terms are range partitioned once, for
    all kinds and positions, and a task sorts one range. A position that a kind does not
    have gives no row.
    """
    if 0 in positions:
        raise ValueError("positions start at 1, or at -1 from the end")
    numbered = with_ordinals(counts, kind, "term")
    ends = numbered.groupBy(kind).agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))
    asked = F.array(*[F.lit(p) for p in positions]).cast("array<bigint>")
    place = F.when(F.col("position") > 0, F.col("first") + F.col("position") - 1).otherwise(
        F.col("last") + F.col("position") + 1)
    places = materialize(
        ends.withColumn("position", F.explode(asked)).withColumn("ordinal", place)
        .where(F.col("ordinal").between(F.col("first"), F.col("last")))
        .select(kind, "position", "ordinal"), "places")
    sought = F.broadcast(places) if fits_broadcast(places) else places
    return numbered.join(sought, [kind, "ordinal"]).select(kind, "position", "term", "n")


def term_at(counts: DataFrame, position: int, from_end: bool = False) -> DataFrame:
    """The term at a 1-based position of the sorted terms, with its count.

    Each task keeps its first ``position`` terms only, so there is no global
    sort. It suits the small positions of a report.
    """
    order = F.col("term").desc() if from_end else F.col("term").asc()
    return counts.orderBy(order).offset(position - 1).limit(1)
