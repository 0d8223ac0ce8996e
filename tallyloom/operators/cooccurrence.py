"""Co-occurrence of distinct tokens within a line, and pointwise mutual information.

Tokens that pass the minimum count get a numeric id, the most frequent the least.
Pairs are counted on ids, once per unordered pair, and turned back into words after
the minimum count has been applied to them.
"""

from __future__ import annotations

import copy
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.arrays import once
from tallyloom.functions.measures import pmi
from tallyloom.functions.text import distinct_tokens
from tallyloom.operators import ordinals, pair_blocks
from tallyloom.operators.words import line_tokens
from tallyloom.plans import lookups
from tallyloom.plans.lookups import lookup
from tallyloom.plans.ranking import best_of_each
from tallyloom.plans.storage import materialize

MIN_COUNT = 10

# A line with more distinct tokens than this is paired up in several groups.
BLOCK_TOKENS = 256

# How many pairs one task should gather from lines, and how many it should count.
PAIRS_GATHERED = 1 << 26
PAIRS_COUNTED = 1 << 22

# Pairs of these most frequent tokens are added up before they are shuffled.
HEAD_TOKENS = 1024

# Ids begin here when they travel, so that the most frequent 65 536 take two bytes.
FIRST_ID = -(1 << 15)
SHORT_IDS = 1 << 15

# A stripe with more entries than this is stored as several maps.
STRIPE_ENTRIES = 65536


def token_marginals(lines: DataFrame, text: str = "line") -> DataFrame:
    """(w, n): the number of lines that hold the token."""
    return (
        line_tokens(lines, text).groupBy(F.col("token").alias("w")).agg(F.count("*").alias("n"))
    )


class Vocabulary:
    """The tokens in at least ``min_count`` lines, with ids, and the total N.

    ``total`` says which marginals N adds up: those of the frequent tokens, or
    of all tokens.
    """

    def __init__(self, lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT,
                 total: str = "frequent"):
        if total not in ("frequent", "all"):
            raise ValueError(f"unknown total {total!r}")
        self.min_count = min_count
        words = lines.select(once(distinct_tokens(F.col(text))).alias("_words"))
        words = words.select(F.explode("_words").alias("w"), F.size("_words").alias("_size"))
        # The sizes of a token's lines say how many pairs it will be in.
        counts = words.groupBy("w").agg(
            F.count("*").alias("n"), F.sum(F.col("_size") - 1).alias("partners")
        )
        frequent = F.col("n") >= min_count
        if total == "frequent":
            counts = counts.where(frequent)
        # The ids are written with the words, so every later read sees the same ones.
        ranked = ordinals.with_ordinals(counts.withColumn("_rarity", -F.col("n")), "_rarity", "w")
        stored = materialize(ranked.drop("_rarity").withColumnRenamed("ordinal", "wid"), "vocabulary")
        self.words = stored.where(frequent)
        self._total = stored.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))

    def up_to(self, ceiling: int) -> Vocabulary:
        """Only the tokens in at most ``ceiling`` lines, with the same ids and total."""
        some = copy.copy(self)
        some.words = self.words.where(F.col("n") <= ceiling)
        return some

    def total(self) -> Column:
        return self._total.scalar()

    def size(self) -> int:
        return self.words.count()

    def places(self) -> int:
        """How often frequent tokens are in lines, each once in a line."""
        return self.words.agg(F.sum("n").alias("n")).first()["n"] or 0

    def pairs_met(self) -> int:
        """An upper bound of the pairs of frequent tokens that occur in lines."""
        return (self.words.agg(F.sum("partners").alias("n")).first()["n"] or 0) // 2


def _with_numbers(lines: DataFrame, text: str) -> DataFrame:
    """(_words, _line): the distinct tokens of each line that has several.

    Lines are numbered here, since nothing that the caller has in other columns need tell
    them apart.
    """
    words = lines.select(once(distinct_tokens(F.col(text))).alias("_words"))
    return words.where(F.size("_words") > 1).withColumn("_line", F.monotonically_increasing_id())


def _numbered(lines: DataFrame, text: str) -> DataFrame:
    """The same, written with their numbers, for plans that shuffle them or read them repeatedly."""
    return materialize(_with_numbers(lines, text), "lines")


def _frequent_ids(numbered: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per line and token: the line's number, the id, its block and the number of blocks."""
    placed = numbered.select(
        "_line",
        F.ceil(F.size("_words") / F.lit(BLOCK_TOKENS)).cast("int").alias("_blocks"),
        F.posexplode("_words").alias("_pos", "w"),
    ).withColumn("_block", F.expr(f"_pos div {BLOCK_TOKENS}").cast("int")).drop("_pos")
    frequent = vocabulary.words
    ids = frequent.select("w", (F.col("wid") + FIRST_ID).cast("int").alias("wid"))
    return lookup(placed, ids, "w", weight=frequent.select("w", "n")).drop("w")


def _id_pairs(lines: DataFrame, text: str, vocabulary: Vocabulary, named: bool = False) -> DataFrame:
    """(a, b, nxy) of lines, which are written only where few pairs are counted from them."""
    cores = lines.sparkSession.sparkContext.defaultParallelism
    if vocabulary.pairs_met() > cores * PAIRS_COUNTED:
        return _pairs_of_numbered(_with_numbers(lines, text), vocabulary, named)
    return _pairs_of_numbered(_numbered(lines, text), vocabulary)


def _ids_of(vocabulary: Vocabulary) -> DataFrame:
    return vocabulary.words.select("w", F.col("wid").cast("int").alias("wid"))


def _owned_ids(numbered: DataFrame, vocabulary: Vocabulary, tasks: int) -> DataFrame:
    """(_owner, _near, _far): for each token of a line the line's more frequent ones.

    The ids of a line are gathered by pair of blocks. A usual line is one block;
    a very long one becomes many groups of at most two blocks. They are dealt out by
    the number of pairs to come, which their size in bytes does not show. ``_near``
    has the ids of two bytes, ``_far`` the others; without any it is null.
    """
    ids = _frequent_ids(numbered, vocabulary)
    met = ids.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    met = met.select(
        "_line", F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high"),
        (F.col("_block") <= F.col("_other")).alias("_in_low"), "wid",
    )
    group = ["_line", "_low", "_high"]
    is_short = F.col("wid") < SHORT_IDS
    groups = met.repartition(tasks, *group).groupBy(*group).agg(
        F.sort_array(F.collect_list(F.when(F.col("_in_low"), F.col("wid")))).alias("_left"),
        F.collect_list(F.when(~F.col("_in_low"), F.col("wid"))).alias("_right"),
        F.sort_array(F.collect_list(F.when(
            is_short & (F.col("_low") == F.col("_high")), F.col("wid").cast("smallint")))).alias("_short"),
    )
    owned = groups.select(
        "_left", "_right", "_short", (F.col("_low") == F.col("_high")).alias("_alone"),
        F.posexplode(F.concat("_left", "_right")).alias("_at", "_owner"))
    in_left, n_short = F.col("_at") < F.size("_left"), F.size("_short")
    others = F.when(in_left, F.col("_right")).otherwise(F.col("_left"))

    def near(other: Column) -> Column:
        return (other < F.col("_owner")) & (other < SHORT_IDS)

    def far(other: Column) -> Column:
        return (other < F.col("_owner")) & (other >= SHORT_IDS)

    return owned.select(
        "_owner",
        F.when(F.col("_alone"), F.slice("_short", 1, F.least("_at", n_short)))
        .otherwise(F.filter(others, near).cast("array<smallint>")).alias("_near"),
        F.when(F.col("_alone"), F.slice("_left", n_short + 1, F.greatest(F.col("_at") - n_short, F.lit(0))))
        .otherwise(F.filter(others, far)).alias("_far"),
    ).where(F.size("_near") + F.size("_far") > 0).withColumn(
        "_far", F.when(F.size("_far") > 0, F.col("_far")))


def _pairs_of_numbered(numbered: DataFrame, vocabulary: Vocabulary, named: bool = False) -> DataFrame:
    """(a, b, nxy) with a < b, for the pairs that reach the minimum count.

    Many pairs are counted in blocks, for which ids are written once and read a few times,
    and few pairs where their tokens are, to which ids travel as often as they meet. If
    ``named``, pairs whose words cannot be broadcast get them and (nx, ny) in the blocks.
    """
    cores = numbered.sparkSession.sparkContext.defaultParallelism
    met = vocabulary.pairs_met()
    if met <= cores * PAIRS_COUNTED:
        return _pairs_of_owners(numbered, vocabulary, cores, met)
    groups = pair_blocks.groups_for(vocabulary.places(), cores)
    placed = numbered.select("_line", F.explode("_words").alias("w"))
    ids = _ids_of(vocabulary)
    names = vocabulary.words.select(F.col("wid").alias("id"), "w", "n")
    names = (names,) if named and not lookups.fits_broadcast(names) else ()
    if lookups.fits_broadcast(ids):
        # The ids of a line stay together where the words are looked up without a shuffle.
        placed = placed.join(F.broadcast(ids), "w")
        return pair_blocks.pair_counts(placed, "wid", groups, vocabulary.min_count, "_line", *names)
    lines = _ids_of_lines(placed, vocabulary).repartition(
        max(cores, math.ceil(met / PAIRS_GATHERED)), "_line").groupBy("_line").agg(
        F.flatten(F.collect_list("_ids")).alias("_ids"))
    return pair_blocks.pair_counts(lines, "_ids", groups, vocabulary.min_count, None, *names)


def _ids_of_lines(placed: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(_line, _ids): the ids of lines in one or several rows, for a vocabulary of any size.

    As many of the most frequent words as can be broadcast are looked up where they are, and
    the lines are written as ids. Only their other words, which are few, are shuffled.
    """
    ids = _ids_of(vocabulary)
    first = ids.agg(F.min("wid").alias("first")).first()["first"]
    end = first + vocabulary.size() * lookups.BROADCAST_BYTES // lookups.measured(ids)
    near = placed.join(F.broadcast(ids.where(F.col("wid") < end)), "w", "left")
    coded = materialize(pair_blocks.gathered(
        near.select("_line", F.col("wid").alias("_ids"), F.when(F.col("wid").isNull(), F.col("w")).alias("_rest")),
        "_line", "_ids", "_rest"), "coded")
    weight = vocabulary.words.where(F.col("wid") >= end).select("w", "n")
    rest = lookup(coded.select("_line", F.explode("_rest").alias("w")), ids.where(F.col("wid") >= end), "w", weight)
    return coded.where(F.size("_ids") > 0).select("_line", "_ids").unionByName(
        rest.select("_line", F.array("wid").alias("_ids")))


def _pairs_of_owners(numbered: DataFrame, vocabulary: Vocabulary, cores: int, met: int) -> DataFrame:
    """The pairs, each counted at its rarer token.

    A pair is counted where its rarer token is, which gets the more frequent ones of
    each line as one array of ids. Few pairs are so frequent that adding them up first
    would save more; those of the most frequent tokens are, and no other token has more
    than a small share of all pairs.
    """
    owned = _owned_ids(numbered, vocabulary, max(cores, math.ceil(met / PAIRS_GATHERED)))
    is_head = F.col("_owner") < FIRST_ID + HEAD_TOKENS
    every = F.when(F.col("_far").isNull(), F.col("_near").cast("array<int>")).otherwise(
        F.concat(F.col("_near").cast("array<int>"), "_far"))
    of_heads = owned.where(is_head).select("_owner", F.explode(every).alias("_id"))
    of_others = owned.where(~is_head).repartition(
        max(cores, math.ceil(met / PAIRS_COUNTED)), "_owner").select("_owner", F.explode(every).alias("_id"))
    counted = [
        pairs.groupBy("_owner", "_id").agg(F.count("*").alias("nxy")).where(F.col("nxy") >= vocabulary.min_count)
        for pairs in (of_heads, of_others)]
    return counted[0].unionByName(counted[1]).select(
        (F.col("_id").cast("bigint") - FIRST_ID).alias("a"),
        (F.col("_owner").cast("bigint") - FIRST_ID).alias("b"), "nxy")


def _named(pairs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(x, y, nxy, nx, ny) for id pairs, one row per unordered pair."""
    if "x" in pairs.columns:
        return pairs.select("x", "y", "nxy", "nx", "ny")
    words = vocabulary.words
    left = words.select(F.col("wid").alias("a"), F.col("w").alias("x"), F.col("n").alias("nx"))
    right = words.select(F.col("wid").alias("b"), F.col("w").alias("y"), F.col("n").alias("ny"))
    return lookup(lookup(pairs, left, "a"), right, "b").select("x", "y", "nxy", "nx", "ny")


def _both_orders(pairs: DataFrame) -> DataFrame:
    swap = {"x": "y", "y": "x", "nx": "ny", "ny": "nx"}
    there = F.struct(*[F.col(c) for c in pairs.columns])
    back = F.struct(*[F.col(swap.get(c, c)).alias(c) for c in pairs.columns])
    return pairs.select(F.inline(F.array(there, back)))


def pair_counts(lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT,
                vocabulary: Vocabulary | None = None) -> DataFrame:
    """(x, y, nxy): lines that hold both, in both orders, with nxy >= min_count.

    A pair cannot be more frequent than its rarer token, so rare tokens are left
    out before pairing.
    """
    vocabulary = vocabulary or Vocabulary(lines, text, min_count)
    named = _named(_id_pairs(lines, text, vocabulary, True), vocabulary)
    return _both_orders(named.select("x", "y", "nxy"))


def pair_total(lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT) -> DataFrame:
    """Number of ordered pairs that reach the minimum count."""
    counted = _id_pairs(lines, text, Vocabulary(lines, text, min_count))
    return counted.agg((F.count("*") * 2).alias("n_pairs"))


def pmi_pairs(lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT,
              total: str = "frequent", vocabulary: Vocabulary | None = None) -> DataFrame:
    """(x, y, pmi) in both orders."""
    vocabulary = vocabulary or Vocabulary(lines, text, min_count, total)
    named = _named(_id_pairs(lines, text, vocabulary, True), vocabulary)
    score = pmi(F.col("nxy"), F.col("nx"), F.col("ny"), vocabulary.total())
    return _both_orders(named.select("x", "y", score.alias("pmi")))


def stripes(lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT,
            vocabulary: Vocabulary | None = None, entries: int = STRIPE_ENTRIES) -> DataFrame:
    """(x, part, nx, stripe): for every word a map from neighbour to count.

    A word with more than ``entries`` neighbours has several parts, chosen by a
    hash of the neighbour; all other words have part 0 only.
    """
    return _stripes(lines, text, vocabulary or Vocabulary(lines, text, min_count), entries)


def _stripes(lines: DataFrame, text: str, vocabulary: Vocabulary, entries: int, with_ny: bool = False) -> DataFrame:
    """The stripes; ``with_ny``, those of words that cannot be broadcast have the column ``ny``,
    too: the neighbours' own counts, in the order of the map."""
    counted = materialize(_id_pairs(lines, text, vocabulary, True), "pairs")
    if "x" in counted.columns:
        return _stripes_of_named(counted, entries, ["y", "nxy", "ny"] if with_ny else ["y", "nxy"])
    there, back = [F.struct(F.col(x).alias("_x"), F.col(y).alias("_y"), "nxy") for x, y in ("ab", "ba")]
    pairs = counted.select(F.inline(F.array(there, back)))
    lengths = materialize(pairs.groupBy("_x").agg(F.count("*").alias("n")), "lengths")
    parts = lengths.select("_x", F.ceil(F.col("n") / F.lit(entries)).alias("_parts"))
    words = vocabulary.words
    left = words.select(F.col("wid").alias("_x"), F.col("w").alias("x"), F.col("n").alias("nx"))
    right = words.select(F.col("wid").alias("_y"), F.col("w").alias("y"))
    # Each word is a neighbour as often as it has neighbours.
    met = lengths.withColumnRenamed("_x", "_y")
    hashed = right.select("_y", F.xxhash64("y").alias("_hash"))
    placed = lookup(lookup(pairs, parts, "_x", weight=lengths), hashed, "_y", weight=met)
    part = F.pmod("_hash", F.col("_parts"))
    # The pairs travel as numbers and get their words where the stripes are made.
    dealt = placed.select("_x", part.alias("part"), "_y", "nxy").repartition("_x", "part")
    named = lookup(lookup(dealt, right, "_y", weight=met), left, "_x", weight=lengths)
    cells = F.sort_array(F.collect_list(F.struct("y", "nxy")))
    made = named.groupBy("_x", "part", "x", "nx").agg(F.map_from_entries(cells).alias("stripe"))
    return made.select("x", "part", "nx", "stripe")


def _stripes_of_named(counted: DataFrame, entries: int, cells: list[str]) -> DataFrame:
    """The stripes of written pairs that have their words already, from one shuffle of them.

    Only a word with several parts, of which there are few, is looked up.
    """
    lengths = counted.select(F.explode(F.array("a", "b")).alias("_x")).groupBy("_x").agg(F.count("*").alias("n"))
    several = materialize(lengths.where(F.col("n") > entries).select(
        "_x", F.ceil(F.col("n") / F.lit(entries)).alias("_parts")), "several")
    there, back = [F.struct(F.col(i).alias("_x"), F.col(x).alias("x"), F.col(nx).alias("nx"),
                            F.col(y).alias("y"), "nxy", F.col(ny).alias("ny"))
                   for i, x, nx, y, ny in (("a", "x", "nx", "y", "ny"), ("b", "y", "ny", "x", "nx"))]
    pairs = counted.select(F.inline(F.array(there, back)))
    near = F.broadcast(several) if lookups.fits_broadcast(several) else several
    part = F.coalesce(F.pmod(F.xxhash64("y"), F.col("_parts")), F.lit(0).cast("bigint"))
    dealt = pair_blocks.cells(pairs.join(near, "_x", "left").withColumn("part", part), cells)
    made = dealt.repartition("x", "part").groupBy("x", "part", "nx").agg(F.sort_array(
        F.arrays_zip(*(F.flatten(F.collect_list(c)).alias(c) for c in cells))).alias("_cells"))
    stripe = F.map_from_entries(F.transform("_cells", lambda c: F.struct(c["y"], c["nxy"])))
    return made.select("x", "part", "nx", stripe.alias("stripe"), *(F.col(f"_cells.{c}") for c in cells[2:]))


def pairs_of_stripes(table: DataFrame) -> DataFrame:
    return table.select("x", "nx", F.explode("stripe").alias("y", "nxy"))


def pmi_stripes(lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT,
                total: str = "all", vocabulary: Vocabulary | None = None) -> DataFrame:
    """(x, y, pmi) from stripes: nx is in the stripe, ny is looked up per entry or with the pairs."""
    vocabulary = vocabulary or Vocabulary(lines, text, min_count, total)
    table = _stripes(lines, text, vocabulary, STRIPE_ENTRIES, True)
    if "ny" in table.columns:
        scored = table.select("x", "nx", F.inline(F.arrays_zip(
            F.map_keys("stripe").alias("y"), F.map_values("stripe").alias("nxy"), "ny")))
    else:
        neighbours = vocabulary.words.select(F.col("w").alias("y"), F.col("n").alias("ny"))
        scored = lookup(pairs_of_stripes(table), neighbours, "y")
    score = pmi(F.col("nxy"), F.col("nx"), F.col("ny"), vocabulary.total())
    return scored.select("x", "y", score.alias("pmi"))


def pmi_of_anchors(lines: DataFrame, anchors: list[str], text: str = "line",
                   min_count: int = MIN_COUNT, total: str = "frequent",
                   vocabulary: Vocabulary | None = None) -> DataFrame:
    """The rows of ``pmi_pairs`` whose x is an anchor, without pairing other words."""
    vocabulary = vocabulary or Vocabulary(lines, text, min_count, total)
    words = lines.select(once(distinct_tokens(F.col(text))).alias("_words"))
    named = F.array_intersect("_words", F.array(*[F.lit(a) for a in anchors]))
    met = (
        words.select("_words", F.explode(named).alias("x"))
        .select("x", F.explode("_words").alias("y"))
        .where(F.col("x") != F.col("y"))
    )
    counted = met.groupBy("x", "y").agg(F.count("*").alias("nxy"))
    counted = counted.where(F.col("nxy") >= vocabulary.min_count)
    tokens = vocabulary.words
    left = tokens.where(F.col("w").isin(anchors)).select(
        F.col("w").alias("x"), F.col("n").alias("nx")
    )
    right = tokens.select(F.col("w").alias("y"), F.col("n").alias("ny"))
    scored = lookup(lookup(counted, left, "x"), right, "y")
    score = pmi(F.col("nxy"), F.col("nx"), F.col("ny"), vocabulary.total())
    return scored.select("x", "y", score.alias("pmi"))


def greatest_pmi(scores: DataFrame) -> DataFrame:
    """The pair with the greatest score; ties go to the smaller words."""
    return scores.orderBy(F.col("pmi").desc(), "x", "y").limit(1)


def greatest_pmi_pair(lines: DataFrame, text: str = "line", min_count: int = MIN_COUNT,
                      total: str = "frequent", vocabulary: Vocabulary | None = None,
                      report: list[tuple[int, int, int]] | None = None) -> DataFrame:
    """The row of ``greatest_pmi`` over all pairs, without pairing all words.

    Neither word of a pair is in fewer lines than the pair, so its score is at most
    log10(N / max(nx, ny)). Words are paired from the rarest on, up to a ceiling on their
    lines that doubles until the best pair found is above the bound of all others, or
    no word is left. No frequent pair gives no row. ``report`` gets (ceiling, words, bound
    of the pairs met) for each round.
    """
    vocabulary = vocabulary or Vocabulary(lines, text, min_count, total)
    largest = vocabulary.words.agg(F.max("n").alias("n")).first()["n"] or 0
    numbered = _numbered(lines, text)
    ceiling = 2 * max(1, min_count)
    while True:
        some = vocabulary.up_to(ceiling)
        if report is not None:
            report.append((ceiling, some.size(), some.pairs_met()))
        named = _named(_pairs_of_numbered(numbered, some, True), some)
        score = pmi(F.col("nxy"), F.col("nx"), F.col("ny"), vocabulary.total())
        best = materialize(greatest_pmi(_both_orders(named.withColumn("pmi", score))), "best")
        found = best.first()
        # All other pairs have a word in more lines than the ceiling.
        if ceiling >= largest or (found and found.nxy * ceiling >= found.nx * found.ny):
            return best.select("x", "y", "pmi")
        ceiling *= 2


def top_neighbours(scores: DataFrame, k: int = 3) -> DataFrame:
    """The k best neighbours of every x, ranked; ties go to the smaller word."""
    return best_of_each(scores, "x", [F.col("pmi").desc(), F.col("y")], k)
