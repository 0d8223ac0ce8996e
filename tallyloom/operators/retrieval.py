"""Postings lookup and Boolean retrieval over (term, doc_id, tf) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import postfix_condition, preview, query_terms
from tallyloom.plans.lookups import fits_broadcast
from tallyloom.plans.storage import materialize


def lookup_postings(frequencies: DataFrame, *terms: str) -> DataFrame:
    """The postings of one or more terms, in one read."""
    return frequencies.where(F.col("term").isin(list(terms)))


def missing_terms(frequencies: DataFrame, terms: list[str]) -> DataFrame:
    """Those of the terms that occur in no document."""
    asked = frequencies.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in terms])).alias("term"))
    # At most one row per asked term is left to join with.
    present = lookup_postings(frequencies, *terms).groupBy("term").agg(F.count("*").alias("n"))
    return asked.distinct().join(present, "term", "left_anti")


def boolean_batch(frequencies: DataFrame, queries: dict[str, str]) -> DataFrame:
    """(query_id, doc_id) for postfix AND/OR queries, all answered in one pass.

    The postings of all terms are read once and gathered by document into one
    flag per term; every query is a condition on these flags.
    """
    terms = query_terms(list(queries.values()))
    flags = {term: f"has_{i}" for i, term in enumerate(terms)}
    answers = F.array(*[
        F.when(postfix_condition(query, lambda t: F.col(flags[t])), F.lit(name))
        for name, query in queries.items()
    ])
    documents = lookup_postings(frequencies, *terms).groupBy("doc_id").agg(
        *[F.bool_or(F.col("term") == term).alias(flag) for term, flag in flags.items()]
    )
    return documents.select(F.explode(F.array_compact(answers)).alias("query_id"), "doc_id")


def boolean_query(frequencies: DataFrame, query: str) -> DataFrame:
    """The ids of the documents that match one postfix query."""
    return boolean_batch(frequencies, {"": query}).select("doc_id")


def boolean_and(frequencies: DataFrame, left: str, right: str) -> DataFrame:
    return boolean_query(frequencies, f"{left} {right} AND")


def boolean_or(frequencies: DataFrame, left: str, right: str) -> DataFrame:
    return boolean_query(frequencies, f"{left} {right} OR")


def fetch(hits: DataFrame, documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The hits with the text of their documents.

    The hits are written and measured. Below the limit they travel to the texts;
    beyond it both sides are shuffled, and Spark may keep other texts back by a
    Bloom filter of the hits.
    """
    found = materialize(hits, "hits")
    near = F.broadcast(found) if fits_broadcast(found) else found
    return documents.select(key, text).join(near, key).select(*hits.columns, text)


def fetch_preview(hits: DataFrame, documents: DataFrame, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """The hits with the first 80 characters; texts are cut before they travel."""
    return fetch(hits, documents.select(key, preview(F.col(text)).alias("preview")), key, "preview")
