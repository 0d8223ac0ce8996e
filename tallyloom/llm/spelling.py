"""Grouping of spelling variants with an index of grams of variable length.

1. The dictionary holds the grams that many words have, found length by length: a gram
   is counted only if the gram without its last character is frequent.
2. A word, padded on both sides, has one gram at each place: the shortest one there that
   is not frequent, or one of the greatest length. So common beginnings are written out
   further than rare ones. A gram depends on its own characters alone.
3. An edit of one character changes no gram but those over its place; the most that lie
   over one character bound the affected grams of a word. Grams that an edit spares are in
   both words, at the same place or one further on.
4. If an edit can affect k grams, then of the k + 1 rarest grams of a word, in an order
   that all words share, one is spared and is among the rarest of the other word too. So
   only these lists are merged, split by the place of the gram and the length of the word.
5. Words that meet are verified by their edit distance.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize

# Fixed values of the words: what a run is made of, and the letters that are lowered.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SHORTEST, LEAST_COUNT, DAMAGE = 5, 3, 97

# Lengths of grams. A gram is frequent if more words than FREQUENT have it, or more than
# keep the dictionary at DICTIONARY grams.
SHORT, LONG = 2, 6
FREQUENT, DICTIONARY = 64, 1 << 19
PAD_LEFT, PAD_RIGHT = "^" * (LONG - 1), "$" * (LONG - 1)


def damaged_runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every run of letters of at least SHORTEST characters as ``word``, A-Z lowered, one
    character deleted where 97 divides the checksum of id and run. A null id is empty there."""
    runs = documents.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.coalesce(text_column, F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= SHORTEST).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    checked = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % DAMAGE == 0, F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))).otherwise(F.col("run"))
    return checked.select(word.alias("word")).where(F.char_length("word") >= SHORTEST)


def word_counts(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def frequent_grams(words: DataFrame, frequent: int = FREQUENT, most: int = DICTIONARY) -> dict[str, int]:
    """Grams of SHORT to LONG characters that more than ``frequent`` places have, with their number.

    A place has one gram of each length, so a limit of places times lengths over ``most``
    bounds the dictionary, which is held by the driver and broadcast.
    """
    spark = words.sparkSession
    places = words.agg(F.sum(F.char_length("word") + LONG - 1).alias("places")).first()["places"] or 0
    limit = max(frequent, -(-places * (LONG - SHORT + 1) // most))
    found: dict[str, int] = {}
    begun = None
    for length in range(SHORT, LONG + 1):
        held = spark.sparkContext.broadcast(begun)

        def count(batches: Iterator[pa.RecordBatch], length=length, held=held) -> Iterator[pa.RecordBatch]:
            known = held.value
            for batch in batches:
                seen: Counter = Counter()
                for word in batch.column(0).to_pylist():
                    word = PAD_LEFT + word + PAD_RIGHT
                    grams = [word[p:p + length] for p in range(len(word) - LONG + 1)]
                    seen.update(grams if known is None else (g for g in grams if g[:-1] in known))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["gram", "n"])

        grams = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(
            F.sum("n").alias("n")).where(F.col("n") > limit)
        begun = {gram: n for gram, n in grams.toLocalIterator()}
        found.update(begun)
        if not begun:
            break
    return found


def decompose(word: str, frequent: dict[str, int]) -> tuple[list[tuple[int, str]], int]:
    """The grams of a word as (place, gram), and the most of them that one edit affects."""
    padded = PAD_LEFT + word + PAD_RIGHT
    grams, over = [], [0] * (len(padded) + 1)
    for p in range(len(padded) - LONG + 1):
        length = SHORT
        while length < LONG and padded[p:p + length] in frequent:
            length += 1
        grams.append((p, padded[p:p + length]))
        over[p] += 1
        over[p + length] -= 1
    most = lying = 0
    for i, change in enumerate(over):
        lying += change
        if LONG - 1 <= i < LONG - 1 + len(word):
            most = max(most, lying)
    return grams, most


def _rarest(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    grams, affected = decompose(word, frequent)
    grams.sort(key=lambda g: (frequent.get(g[1], 0), zlib.crc32(g[1].encode()), g[1], g[0]))
    return grams[:affected + 1]


def index(words: DataFrame, dictionary: Broadcast) -> DataFrame:
    """(word, n, size, gram, place): the lists of the rarest grams."""
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = dictionary.value
        for batch in batches:
            at, grams, places, sizes = [], [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                for place, gram in _rarest(word, frequent):
                    at.append(i)
                    grams.append(gram)
                    places.append(place)
                    sizes.append(len(word))
            picked = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(sizes, pa.int32()), pa.array(grams, pa.string()), pa.array(places, pa.int32())],
                ["word", "n", "size", "gram", "place"])

    return words.select("word", "n").mapInArrow(lists, "word string, n long, size int, gram string, place int")


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): pairs of words that differ by one insertion, deletion or replacement, once each.

    Two words of the same length share a spared gram at the same place; in a word that is
    one longer it is there or one further on.
    """
    spark = words.sparkSession
    dictionary = spark.sparkContext.broadcast(frequent_grams(words))
    lists = materialize(index(words, dictionary), "grams")

    def key(place: Column, size: Column) -> Column:
        return F.xxhash64("gram", place, size)

    place, size = F.col("place"), F.col("size")
    left = lists.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.explode(F.array(
        F.struct(key(place, size).alias("key"), F.lit(True).alias("same")),
        F.struct(key(place, size + 1).alias("key"), F.lit(False).alias("same")),
        F.struct(key(place + 1, size + 1).alias("key"), F.lit(False).alias("same")))).alias("to")).select(
            "a", "a_n", "to.key", "to.same")
    right = lists.select(F.col("word").alias("b"), F.col("n").alias("b_n"), key(place, size).alias("key"))
    met = left.join(right, "key").where((~F.col("same") | (F.col("a") < F.col("b")))
                                        & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following (word, form) to the last; each round doubles the steps."""
    jumps = materialize(forms.select("word", F.col("form").alias("root")), "jumps")
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumps = materialize(jumps.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "jumps")
        if not jumps.where("moved").limit(1).count():
            return jumps.select("word", "root")
        jumps = jumps.drop("moved")


def variants(words: DataFrame) -> DataFrame:
    """Near words, form and root of each of the words (word, n).

    Returns word, form (the near word of largest n, the first in code-point order among
    equals, if its n is at least twice the word's; else null), root (reached by following
    forms; the word itself without one), n, n_near and form_n. Along forms n at least
    doubles, so they end. An empty table gives no row.
    """
    words = materialize(words.select("word", "n"), "words")
    pairs = materialize(near_words(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.less") >= 2 * F.col("n"), -F.col("best.less")).alias("form_n")), "found")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``variants`` of the words of whole texts.

    Null and empty texts have no words; a null id is taken as empty in the checksum.
    Repeated rows count each. A text of any length is cut in its row. Other columns are
    not read; an empty table gives no row.
    """
    return variants(word_counts(damaged_runs(documents, id_column, text_column)))
