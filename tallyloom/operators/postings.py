"""Inverted index.

The postings of a term are stored in blocks of a fixed range of document ids, so
a block holds at most ``BLOCK_DOCS`` postings however frequent the term is, and
the blocks of a term, read in order, are its postings list in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.arrays import once
from tallyloom.functions.text import index_tokens
from tallyloom.operators import ordinals
from tallyloom.plans.lookups import fits_broadcast
from tallyloom.plans.storage import materialize

BLOCK_DOCS = 65536

# A posting of a block is gathered as one number, the upper bits of which are its id.
TF_BITS = 32

# Maps of more entries than this are made apart from the many small ones.
SMALL_MAP = 1024

# Numbers that pass from block to block do so within this many blocks first.
STRETCH_BLOCKS = 65536


def term_frequencies(documents: DataFrame, key: str = "doc_id", text: str = "text",
                     besides: tuple[str, ...] = ()) -> DataFrame:
    """(term, doc_id, tf), for documents of one row each, and the columns ``besides``.

    A document is in one row, so its histogram needs no shuffle: in its sorted
    tokens, the distance from one term's start to the next one's is the frequency.
    """
    ordered = documents.select(
        F.col(key).alias("doc_id"), *besides, once(F.sort_array(index_tokens(F.col(text)))).alias("ws")
    ).where(F.size("ws") > 0)
    begins = F.expr("filter(sequence(0, size(ws) - 1), i -> i = 0 or ws[i] <> ws[i - 1])")
    runs = ordered.select("doc_id", *besides, "ws", once(begins).alias("starts"))
    return runs.select(
        "doc_id", *besides, "ws", "starts", F.posexplode("starts").alias("nth", "start")
    ).selectExpr(
        "ws[start] as term",
        "doc_id",
        "cast(coalesce(get(starts, nth + 1), size(ws)) - start as bigint) as tf",
        *besides,
    )


def term_stats(frequencies: DataFrame) -> DataFrame:
    """(term, cf, df): occurrences in the collection, and documents with the term."""
    return frequencies.groupBy("term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))


def inverted_index(frequencies: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, postings) with postings an array of (doc_id, tf) in id order.

    A posting is gathered and sorted as one number, its id within the block and its tf.
    One that is none, without an id or with a tf beyond 31 bits, is gathered as it is.
    """
    block = F.coalesce(F.expr(f"doc_id div {block_docs}"), F.lit(0))
    place = F.col("doc_id").cast("bigint") - block * block_docs
    half = 1 << (TF_BITS - 1)
    fits = F.coalesce(F.col("tf").between(0, half - 1) & place.between(-half, half - 1), F.lit(False))
    # Made once and in compiled code: an aggregate would make it anew for each of its functions.
    posting = once(F.struct(
        block.alias("block"),
        F.when(fits, F.shiftleft(place, TF_BITS) + F.col("tf")).alias("packed"),
        F.when(~fits, F.struct("doc_id", "tf")).alias("other"),
    )).alias("posting")
    gathered = frequencies.select("term", posting).groupBy("term", F.col("posting.block").alias("block")).agg(
        F.sort_array(F.collect_list("posting.packed")).alias("_packed"),
        F.collect_list("posting.other").alias("_others"),
    )
    kinds = dict(frequencies.dtypes)

    def unpacked(number: Column) -> Column:
        return F.struct(
            (F.col("block") * block_docs + F.shiftright(number, TF_BITS)).cast(kinds["doc_id"]).alias("doc_id"),
            number.bitwiseAND(F.lit(half - 1)).cast(kinds["tf"]).alias("tf"),
        )

    postings = F.transform("_packed", unpacked)
    return gathered.select("term", "block", F.when(F.size("_others") == 0, postings).otherwise(
        F.sort_array(F.concat(postings, "_others"))).alias("postings"))


def ordinal_index(frequencies: DataFrame, block_docs: int = ordinals.BLOCK_DOCS) -> DataFrame:
    """(term, block, postings) of (term, doc_id, tf, ordinal) rows, in blocks of ordinals.

    Postings are (ordinal, doc_id, tf). A block is full unless documents lack the term,
    whatever the ids are.
    """
    return (
        frequencies.withColumn("block", ordinals.block_of("ordinal", block_docs))
        .groupBy("term", "block")
        .agg(F.sort_array(F.collect_list(F.struct("ordinal", "doc_id", "tf"))).alias("postings"))
    )


def wide_rows(index: DataFrame) -> DataFrame:
    """(term, block, cells): each block as a map from document to frequency.

    Small maps and large ones are made by functions of their own, since a function that
    has made a large map takes as much time to get ready for each map that follows.
    """
    small = F.map_from_arrays("postings.doc_id", "postings.tf")
    cells = F.when(F.size("postings") <= SMALL_MAP, small).otherwise(F.map_from_entries("postings"))
    return index.select("term", "block", once(F.col("postings")).alias("postings")).select(
        "term", "block", once(cells).alias("cells"))


def postings_of(index: DataFrame) -> DataFrame:
    """(term, doc_id, tf) of an index or of wide rows."""
    if "cells" in index.columns:
        return index.select("term", F.explode("cells").alias("doc_id", "tf"))
    return index.select("term", F.inline("postings")).select("term", "doc_id", "tf")


def postings_with_ordinals(index: DataFrame) -> DataFrame:
    """(term, ordinal, doc_id, tf) of an index by ordinals."""
    return index.select("term", F.inline("postings"))


def _over_earlier_blocks(blocks: DataFrame, value: str, total) -> DataFrame:
    """(term, block, near, far): ``total`` of the values in the earlier blocks of the term.

    It is taken in two levels, ``near`` over the blocks of the same stretch and
    ``far`` over the stretches before, so that no task orders all blocks of a term. A
    term's first block has no row.
    """
    near = Window.partitionBy("term", "stretch").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    far = Window.partitionBy("term").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that both levels read the numbers and do not make the blocks again.
    placed = materialize(blocks.withColumn(
        "stretch", F.coalesce(F.expr(f"block div {STRETCH_BLOCKS}"), F.lit(0))
    ), "numbers")
    stretches = placed.groupBy("term", "stretch").agg(total(value).alias("_all"))
    stretches = stretches.select("term", "stretch", total("_all").over(far).alias("far"))
    inside = placed.select("term", "block", "stretch", total(value).over(near).alias("near"))
    later = stretches.where(F.col("far").isNotNull())
    found = inside.join(later, ["term", "stretch"], "left").drop("stretch")
    return materialize(found.where(F.col("near").isNotNull() | F.col("far").isNotNull()), "earlier")


def _with_earlier(blocks: DataFrame, earlier: DataFrame) -> DataFrame:
    """The blocks with the columns of ``earlier``, null for the first block of a term."""
    return blocks.join(F.broadcast(earlier) if fits_broadcast(earlier) else earlier, ["term", "block"], "left")


def gap_index(index: DataFrame) -> DataFrame:
    """(term, block, gaps): each id as its distance from the id before it.

    The first id of a term counts from zero. Only one number per block, its last
    id, travels between the blocks of a term.
    """
    # Written once, as it is read for the ends and for the gaps.
    index = materialize(index.select("term", "block", "postings"), "index")
    ends = index.select("term", "block", F.element_at("postings", -1)["doc_id"].alias("last"))
    before = _over_earlier_blocks(ends, "last", F.max).select(
        "term", "block", F.greatest("near", "far").alias("previous")
    )
    gap = "p.doc_id - if(i = 0, coalesce(previous, 0), postings[i - 1].doc_id)"
    gaps = F.expr(f"transform(postings, (p, i) -> struct({gap} as gap, p.tf as tf))")
    return _with_earlier(index, before).select("term", "block", once(gaps).alias("gaps"))


def from_gaps(gaps: DataFrame) -> DataFrame:
    """(term, doc_id, tf) restored from gaps by running sums, over and in blocks."""
    in_block = (
        Window.partitionBy("term", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    )
    gaps = materialize(gaps, "gaps")
    spans = gaps.select(
        "term", "block",
        F.aggregate("gaps", F.lit(0).cast("bigint"), lambda s, g: s + g["gap"]).alias("span"),
    )
    base = F.coalesce("near", F.lit(0)) + F.coalesce("far", F.lit(0))
    bases = _over_earlier_blocks(spans, "span", F.sum).select("term", "block", base.alias("base"))
    # Blocks get their base and place before they become cells, which are many more rows.
    cells = _with_earlier(gaps.repartition("term", "block"), bases).sortWithinPartitions("term", "block").select(
        "term", "block", F.coalesce("base", F.lit(0)).alias("base"), F.posexplode("gaps").alias("at", "cell")
    )
    return cells.select(
        "term", (F.col("base") + F.sum("cell.gap").over(in_block)).alias("doc_id"), "cell.tf"
    )


def tf_histogram(frequencies: DataFrame, terms: list[str]) -> DataFrame:
    """(term, tf, n_docs): in how many documents a term has which frequency."""
    return (
        frequencies.where(F.col("term").isin(terms))
        .groupBy("term", "tf")
        .agg(F.count("*").alias("n_docs"))
    )
