"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is sought in long documents by containment: the share of its distinct
five-word shingles that a document has; a shorter item is one shingle of all its words.
Items are partitioned by size. Each has a
bottom-k MinHash sketch of its own shingles, k chosen by the partition: where at
least the wanted share is contained, fewer than k shingles of the item can be
missing, so one of its k least hashes must be in the document. Documents are probed
with all their shingles, and every candidate is verified with the exact shingles.
The search misses nothing. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.arrays import once
from tallyloom.llm.common import small_side
from tallyloom.plans.storage import materialize

SHINGLE_WORDS = 5
CONTAINMENT = 0.8

# Fixed value: words are runs of letters and digits, in lower case.
NO_WORD = r"[^\p{L}\p{N}]+"


def item_words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def _starts(words: str, n: int | Column) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1))
    return F.coalesce(starts, F.array().cast("array<int>"))


def shingle_hashes(words: str, n: int | Column = SHINGLE_WORDS) -> Column:
    """Hashes of the n-word shingles of an array column, repeats included."""
    return F.transform(_starts(words, n), lambda i: F.xxhash64(F.slice(words, i, n)))


def shingles(words: str, n: int | Column = SHINGLE_WORDS) -> Column:
    """The distinct n-word shingles of an array column, as strings."""
    return F.array_distinct(F.transform(
        _starts(words, n), lambda i: F.array_join(F.slice(words, i, n), " ")))


def sketches(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(item_id, hash): the k least shingle hashes of each item, k by its size partition.

    Partitions are powers of two of the number of distinct shingles. k is one more
    than the shingles that the largest item of the partition may lack.
    """
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.size("hashes"))))
    k = (F.floor(upper * (1 - containment) + 1e-9) + 1).cast("int")
    return items.select(
        "item_id", F.explode(F.slice("hashes", 1, k)).alias("hash"))


def contained_items(documents: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT,
                    id_column: str = "doc_id", text_column: str = "text",
                    item_id_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """Pairs of a document and a test item that it contains to at least ``containment``.

    Returns doc_id, item_id, item_shingles (distinct shingles of the item), found (how
    many of them the document has) and containment, one row for each pair of ids.

    Case, punctuation and white space do not count. An item of fewer than five words
    is found where its words stand one after the other; documents are probed with shingles
    of as few words only if there are such items. An item without a word is never found,
    nor is a null text. Texts of any length are searched whole. Repeated items and
    documents give one row per pair of ids, with the best containment among rows
    of one id. Null ids are ids. An empty table on either side gives no rows. Other
    columns are not read.
    """
    worded_items = benchmark.select(F.col(item_id_column).alias("item_id"),
                                    once(item_words(item_text_column)).alias("words"))
    width = F.least(F.size("words"), F.lit(SHINGLE_WORDS))
    items = materialize(
        worded_items.where(F.size("words") > 0).select(
            "item_id", width.alias("width"),
            F.array_sort(F.array_distinct(shingle_hashes("words", width))).alias("hashes"),
            shingles("words", width).alias("shingles")), "items")
    widths = sorted(row["width"] for row in items.select("width").distinct().collect()) or [SHINGLE_WORDS]
    sketch = materialize(sketches(items, containment), "sketches")
    worded = documents.select(F.col(id_column).alias("doc_id"),
                              once(item_words(text_column)).alias("words"))
    probes = worded.select("doc_id", F.explode(
        F.concat(*(shingle_hashes("words", n) for n in widths))).alias("hash"))
    candidates = materialize(
        probes.join(small_side(sketch), "hash").groupBy("doc_id", "item_id").agg(
            F.count("*").alias("n")).groupBy("doc_id").agg(F.collect_list(F.struct("item_id")).alias("items")),
        "candidates")
    near = candidates.withColumnRenamed("doc_id", "_id")
    kept = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    sought = kept.join(small_side(near), kept.doc_id.eqNullSafe(F.col("_id")))
    texts = sought.select("doc_id", "items", once(item_words("text")).alias("words")).select(
        "doc_id", "items", once(F.concat(*(shingles("words", n) for n in widths))).alias("has"))
    pairs = texts.select("doc_id", "has", F.explode("items.item_id").alias("_item"))
    wanted = small_side(items.select("item_id", "shingles"))
    found = pairs.join(wanted, F.col("_item").eqNullSafe(F.col("item_id"))).select(
        "doc_id", "item_id", F.size("shingles").alias("item_shingles"),
        F.size(F.array_intersect("shingles", "has")).alias("found"))
    share = F.col("found") / F.col("item_shingles")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.max_by(F.struct("item_shingles", "found"), share).alias("best"))
        .select("doc_id", "item_id", "best.item_shingles", "best.found",
                (F.col("best.found") / F.col("best.item_shingles")).alias("containment"))
        .where(F.col("containment") >= containment)
    )
