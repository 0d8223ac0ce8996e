"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equally many words. The points of the van der Corput
sequence, mapped through the cumulative shares, name the source of each slot. The
documents of a source, in shuffled order, are laid end to end and cut into blocks
of a slot's size; the r-th slot of a source takes its r-th block and starts over
after the last. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD
from tallyloom.operators.ordinals import with_ordinals
from tallyloom.plans.lookups import lookup
from tallyloom.plans.storage import materialize

# Words in a slot and in a block.
BLOCK_WORDS = 512

# Weights of the sources in order, repeating, and how often a document may be taken.
WEIGHTS = (1, 2, 3)
MOST_PASSES = 3

# Slots in one row before they are made, such rows in a task where there are many, and
# sources in one group of running sums.
CHUNK_SLOTS = 1 << 12
CHUNKS_IN_TASK = 256
GROUP_SOURCES = 1 << 12


def source_targets(sources: DataFrame, passes: int = MOST_PASSES) -> DataFrame:
    """Add ``target``: the sum of ``size`` shared by ``weight``, none above ``passes`` sizes.

    What is above is shared again among the rest until no source is above. A round is one
    sum over the sources, which are a written table of any length.
    """
    most = (F.col("size") * passes).cast("double")
    above, known = F.lit(False), -1
    while True:
        now = sources.agg(
            F.sum("size").alias("size"), F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.sum(F.when(above, F.col("size") * passes).otherwise(0)).alias("given"),
            F.count_if(above).alias("n")).first()
        if now["weight"] is None:
            return sources.withColumn("target", most)
        share = F.lit(float(now["size"] - now["given"])) * F.col("weight") / F.lit(float(now["weight"]))
        if now["n"] <= known:
            return sources.withColumn("target", F.when(above, most).otherwise(share))
        # The share of a weight only grows, so that sources above stay above.
        above, known = share > most, now["n"]


def _before(place: Column, end: Column, bits: int) -> Column:
    """How many of the points before that of ``place`` have a place below ``end``.

    A point's number is its place with the ``bits`` bits reversed. The numbers before it
    agree with it down to some bit that is set in it and not in them; as places, these have
    given low bits and free high ones, so that they are counted by a division.
    """
    total = F.lit(0).cast("long")
    for t in range(1, bits + 1):
        low = place.bitwiseAND(F.lit((1 << t - 1) - 1).cast("long"))
        bit = F.shiftright(place, t - 1).bitwiseAND(F.lit(1).cast("long"))
        total = total + bit * F.shiftright(end - low + F.lit((1 << t) - 1).cast("long"), t)
    return total


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: rows (slot, source, pass, block, words).

    ``sources``, a written table, has ``source`` (numbers from 0), ``size`` and ``take`` (words
    to take). A source gets as many slots as its words need. Point number i of the sequence,
    over as many places as the power of two that holds all slots, names the source in whose
    slots its place lies; points beyond the last slot name none and are left out. Each place has
    one point, so every source gets its slots exactly, and every beginning of the mix has each
    source near its share. Slots are numbered without gaps.
    """
    size, take = F.col("size"), F.col("take")
    blocks = F.expr(f"(size + {block_words - 1}) div {block_words}")
    wanted = F.expr(f"(take div size) * blocks + (take % size + {block_words - 1}) div {block_words}")
    counted = sources.where("size > 0 AND take > 0").select(
        "source", "size", "take", blocks.alias("blocks")).withColumn("wanted", wanted).withColumn(
        "group", F.expr(f"source div {GROUP_SOURCES}"))
    groups = counted.groupBy("group").agg(F.sum("wanted").alias("n"))
    # One row for each group of sources.
    groups = groups.select("group", (F.sum("n").over(W.orderBy("group")) - F.col("n")).alias("group_low"))
    low = F.sum("wanted").over(W.partitionBy("group").orderBy("source")) - F.col("wanted")
    total = counted.agg(F.coalesce(F.sum("wanted"), F.lit(0)).alias("n")).first()["n"]
    bits = max(1, (total - 1).bit_length())
    chunks = counted.withColumn("low", low).join(groups, "group").select(
        "source", "size", "take", "blocks", "wanted", (F.col("low") + F.col("group_low")).alias("low"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(wanted - 1) div {CHUNK_SLOTS}"))).alias("chunk"))
    first = F.col("chunk") * CHUNK_SLOTS
    last = F.least(first + CHUNK_SLOTS, "wanted") - 1
    place = F.col("place")
    # So many tasks, whatever the few bytes of the chunks make of it.
    rows = total // CHUNK_SLOTS + 1
    tasks = max(min(rows, sources.sparkSession.sparkContext.defaultParallelism), rows // CHUNKS_IN_TASK)
    slots = chunks.repartition(tasks, "source", "chunk").withColumn(
        "place", F.explode(F.sequence(first + F.col("low"), last + F.col("low")))).select(
        "source", "size", "take", "blocks",
        _before(place, F.lit(total).cast("long"), bits).alias("slot"),
        (_before(place, F.col("low") + F.col("wanted"), bits) - _before(place, F.col("low"), bits)).alias("rank"))
    words = F.least(F.lit(block_words), size - F.col("block") * block_words)
    left = take - F.col("pass") * size - F.col("block") * block_words
    return (
        slots.withColumn("pass", F.expr("rank div blocks").cast("int"))
        .withColumn("block", F.expr("rank % blocks"))
        .select("slot", "source", "pass", "block", F.least(words, left).alias("words"))
    )


def mix(documents: DataFrame, weights: tuple = WEIGHTS, passes: int = MOST_PASSES,
        block_words: int = BLOCK_WORDS, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source") -> DataFrame:
    """How many words of each document the mix takes, and where it begins to.

    Returns one row per input row: doc_id, source, size (words of the text, null: 0),
    source_size, target (words that its source is to give), taken (words taken, repeats
    counted) and first_slot (the slot of the first word taken; null if none is). Sources,
    of any number, weigh ``weights`` in their order, repeating, null last.

    A document without words is taken with 0 words; a text of any length is spread over its
    blocks. Repeated rows are documents of their own. Documents with equal ids have a fixed
    order among each other only as far as their texts differ. If no document has words, all
    targets are 0; an empty table gives no rows. Other columns are not read.
    """
    shuffled = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    source_name = F.col(source_column)
    sized = materialize(documents.select(
        F.col(id_column).alias("doc_id"), source_name.alias("source_name"),
        F.when(source_name.isNull(), "null").otherwise(F.concat(F.lit("="), source_name.cast("string"))).alias("name"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        shuffled.alias("key"), F.xxhash64(text_column).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    ), "sized")

    totals = sized.groupBy("name").agg(
        F.first("source_name").alias("source_name"), F.sum("size").alias("size"), F.count("*").alias("rows"))
    ordered = with_ordinals(totals.withColumn("last", F.col("source_name").isNull()), "last", "source_name")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("ordinal") % len(weights) + 1).cast("int"))
    sources = materialize(source_targets(materialize(
        ordered.select("name", "size", "rows", F.col("ordinal").alias("source"), weight.alias("weight")), "sources"),
        passes).withColumn("take", F.floor(F.col("target") + 0.5)), "targets")
    known = lookup(sized, sources.select("name", "source", F.col("size").alias("source_size"), "target"),
                   "name", sources.select("name", F.col("rows").alias("n"))).drop("name")

    # The place of each document in its source, from sums over ranges of the shuffled order.
    # The row number splits documents with equal ids and texts over ranges, too.
    ranged = materialize(
        known.where("size > 0").repartitionByRange("key", "tie", "row")
        .withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("n"))
    before = sums.select("source", "part", (F.sum("n").over(
        W.partitionBy("source").orderBy("part")) - F.col("n")).alias("before"))
    within = F.sum("size").over(
        W.partitionBy("source", "part").orderBy("key", "tie", "row")
        .rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    placed = ranged.withColumn("within", within).join(before, ["source", "part"]).withColumn(
        "start", F.col("within") + F.col("before"))

    first = F.expr(f"start div {block_words}")
    last = F.expr(f"(start + size - 1) div {block_words}")
    about = ["row", "doc_id", "source_name", "size", "source_size", "target"]
    pieces = placed.select(*about, "source", "start", F.explode(F.sequence(first, last)).alias("block"))
    # Written, so that the join goes by the size of the slots and not by that of their chunks.
    slots = materialize(schedule(sources, block_words).select("source", "block", "words", "slot"), "slots")
    low = F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0))
    high = F.least(
        F.col("start") + F.col("size") - F.col("block") * block_words,
        F.coalesce("words", F.lit(0)))
    taken = (
        pieces.join(slots, ["source", "block"], "left").withColumn("words", F.greatest(high - low, F.lit(0)))
        .groupBy(*about).agg(F.sum("words").cast("long").alias("taken"),
                             F.min(F.when(F.col("words") > 0, F.col("slot"))).alias("first_slot"))
    )
    without = known.where("size = 0").select(
        *about, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot"))
    return taken.unionByName(without).select(
        "doc_id", F.col("source_name").alias("source"), "size", "source_size", "target", "taken", "first_slot")
