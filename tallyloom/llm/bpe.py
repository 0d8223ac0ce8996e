"""Byte-level BPE encoding and decoding with higher-order functions.

A text is cut into words by the pattern of the vocabulary. A word that is no token
itself starts as its single bytes; a fold over it then merges, as long as there is
one, the leftmost adjacent pair of least rank. Ranks come from literal maps. A piece is
the rank of its token, and a map from two ranks to that of the joined token says what a
merge gives. Words of very many bytes are folded as a string of ranks. Tokens that merging
does not lead to, which a training does not make, are looked up before. Decoding
concatenates the bytes of the ids.

The map of pairs is one table in which each first rank has an offset: the entry is at the
offset plus the second rank, and says whose it is. So a lookup reads two array elements
and makes no string. The literal map of strings is an array of small maps, chosen by a
checksum of the key, since a lookup in one map goes over all its entries.

The frequent distinct words of a sample are folded once each; their ids form a table
of bounded size. Texts are exploded into words, joined to that table by broadcast, and
words that it lacks are folded where they are met. As a broadcast join keeps the order
of the rows, the codes of a text follow each other and are put together again in a
stream: no text, word or id is shuffled. The sample decides only how often words are
folded.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.storage import materialize

# Rows of the sample that frequent words come from, the most words that are taken
# from it, and the longest such word in bytes. A code has four bytes an id and no more
# ids than the word has bytes, so the broadcast table has at most WORDS * WORD_BYTES * 5
# bytes; of words that occur in texts, far less.
SAMPLE_ROWS = 1 << 16
WORDS = 1 << 20
WORD_BYTES = 32

# Words of more bytes are folded as one string, in which all places of a pair are
# merged in one step.
LONG_BYTES = 96


def read_ranks(path: str) -> dict[bytes, int]:
    """Token to rank of a rank file: a token in base 64, a blank and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def lookup_in(bound: Column, buckets: int) -> Callable[[Column], Column]:
    """Looks a key up in an array of maps; null if it has none."""
    def get(key: Column) -> Column:
        place = F.crc32(key.cast("binary")).bitwiseAND(F.lit(buckets - 1).cast("long"))
        return F.element_at(bound[place], key)
    return get


def literal_map(entries: dict[str, int]) -> tuple[Column, int]:
    """A map from strings to int as a literal array of maps, and the length of the array."""
    buckets = 1 << max(0, len(entries) - 1).bit_length()
    parts: list[dict] = [{} for _ in range(buckets)]
    for key, value in entries.items():
        parts[zlib.crc32(key.encode()) & (buckets - 1)][key] = value
    return F.from_json(F.lit(json.dumps(parts)), "array<map<string,int>>"), buckets


def pair_table(ranks: dict[bytes, int]) -> tuple[list[int | None], list[int | None], int]:
    """Offsets by first rank, entries by place, and bits, for the pairs that join to a token.

    The pair (a, b) is at offsets[a] + b if the entry there without its lower ``bits`` is a;
    those are the rank of the joined token. Else it joins to none. The ranks with most pairs
    are placed first, each at the first offset that fits.
    """
    pairs: dict[int, dict[int, int]] = {}
    for token, rank in ranks.items():
        for at in range(1, len(token)):
            first, second = ranks.get(token[:at]), ranks.get(token[at:])
            if first is not None and second is not None:
                pairs.setdefault(first, {})[second] = rank
    bits = max(ranks.values()).bit_length()
    entries = np.full(1 << 16, -1)
    offsets: list[int | None] = [None] * (max(ranks.values()) + 1)
    begin, size = 0, None
    for first, row in sorted(pairs.items(), key=lambda item: (-len(item[1]), item[0])):
        seconds = np.array(sorted(row))
        steps = seconds - seconds[0]
        if len(row) != size:
            begin, size = 0, len(row)
        while True:
            while begin + steps[-1] + 4096 > len(entries):
                entries = np.append(entries, np.full(len(entries), -1))
            starts = begin + np.flatnonzero(entries[begin:begin + 4096] < 0)
            for step in steps[1:]:
                starts = starts[entries[starts + step] < 0]
            if len(starts):
                break
            begin += 4096
        entries[starts[0] + steps] = [first << bits | row[b] for b in seconds.tolist()]
        offsets[first] = int(starts[0] - seconds[0])
    end = int(np.flatnonzero(entries >= 0).max(initial=-1)) + 1
    return offsets, [entry if entry >= 0 else None for entry in entries[:end].tolist()], bits


def unmerged(ranks: dict[bytes, int]) -> dict[bytes, int]:
    """The tokens that merging their bytes does not lead to; none in the ranks of a training."""
    def merged(token: bytes) -> int:
        pieces = [token[i:i + 1] for i in range(len(token))]
        while len(pieces) > 1:
            found = [(rank, i) for i in range(len(pieces) - 1)
                     if (rank := ranks.get(pieces[i] + pieces[i + 1])) is not None]
            if not found:
                break
            at = min(found)[1]
            pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]
        return len(pieces)
    return {token: rank for token, rank in ranks.items() if merged(token) > 1}


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _ranges(points: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for point in points:
        if out and out[-1][1] == point - 1:
            out[-1] = (out[-1][0], point)
        else:
            out.append((point, point))
    return out


def _class_body(points: set[int]) -> str:
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ranges(sorted(points)))


def character_classes(spark: SparkSession) -> tuple[dict[str, str], int]:
    r"""The insides of character classes that mean to Java what \s, \p{L} and \p{N}
    mean to the library, whose Unicode version may be another one.

    The library is asked for every character; letters and digits that Java knows
    as well stay a named class, the others are added as ranges. The number is the
    least of the characters that were added.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    bodies, added = {}, 0x110000
    for name in (r"\s", r"\p{L}", r"\p{N}"):
        probe = tiktoken.Encoding("probe", pat_str=name, mergeable_ranks=single, special_tokens={})
        theirs = set(map(ord, probe.decode_bytes(probe.encode_ordinary(every)).decode()))
        bodies[name] = _class_body(theirs)
        if name != r"\s":
            other = name.replace("p", "P")
            ours = set(map(ord, spark.range(1).select(
                F.regexp_replace(F.lit(every), other, "").alias("found")).first()["found"]))
            if ours <= theirs:
                bodies[name] = name + _class_body(theirs - ours)
            added = min({added, *(ours ^ theirs)})
    return bodies, added


def java_pattern(pattern: str, classes: dict[str, str]) -> str:
    r"""The pattern with \s, \S, \p{L} and \p{N} spelled out."""
    out, at, inside = [], 0, False
    while at < len(pattern):
        name = next((n for n in (r"\p{L}", r"\p{N}", r"\s", r"\S") if pattern.startswith(n, at)), None)
        if name:
            body = classes[name.lower() if name == r"\S" else name]
            if name == r"\S" and inside:
                raise ValueError(r"\S inside a class is not supported")
            out.append(body if inside else f"[^{body}]" if name == r"\S" else f"[{body}]")
            at += len(name)
            continue
        if pattern[at] == "\\":
            out.append(pattern[at:at + 2])
            at += 2
            continue
        inside = pattern[at] == "[" or (inside and pattern[at] != "]")
        out.append(pattern[at])
        at += 1
    return "".join(out)


class Vocabulary:
    """The rank map of a file as literals, and its pattern as Java has it."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ranks = read_ranks(path)
        if len(set(ranks.values())) != len(ranks) or any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("ranks must be distinct and hold every single byte")
        classes, self.added = character_classes(spark)
        self.pattern = java_pattern(pattern, classes)
        self.plain = java_pattern(pattern, {r"\s": classes[r"\s"], r"\p{L}": r"\p{L}", r"\p{N}": r"\p{N}"})
        pieces = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.pieces = spark.sparkContext.broadcast(pieces)
        single = [ranks[bytes([i])] for i in range(256)]
        offsets, entries, self.bits = pair_table(ranks)
        self.offsets, self.entries, self.single = (
            F.from_json(F.lit(json.dumps(part)), f"array<{kind}>")
            for part, kind in ((offsets, "int"), (entries, "bigint"), (single, "int")))
        self.codes = F.from_json(F.lit(json.dumps(
            [i.to_bytes(4, "little").hex().upper() for i in range(len(pieces))])), "array<string>")

        others = unmerged(ranks)
        self.whole = literal_map({token.hex().upper(): rank for token, rank in others.items()}) if others else None

    def with_pairs(self, use: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
        """``use`` of the function that looks up the rank to which two ranks join.

        Where they join to none, it is null or not below ``no_rank``.
        """
        def pair(offsets: Column, entries: Column) -> Callable[[Column, Column], Column]:
            # The bits of a first rank vanish only from its own entries.
            return lambda a, b: F.get(entries, F.get(offsets, a) + b).bitwiseXOR(
                F.shiftleft(a.cast("bigint"), self.bits))
        return bound(self.offsets, lambda o: bound(self.entries, lambda e: use(pair(o, e))))

    @property
    def no_rank(self) -> Column:
        return F.lit(1 << self.bits).cast("bigint")

    def words(self, text: Column) -> Column:
        """The matches of the pattern in the text; none in a null text.

        Texts of characters below those that Java lacks take the shorter classes.
        """
        text = F.coalesce(text, F.lit(""))
        found = [F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in (self.pattern, self.plain)]
        return F.when(text.rlike(f"[\\x{{{self.added:x}}}-\\x{{10ffff}}]"), found[0]).otherwise(found[1])


def _fold_pieces(single: Column, pair: Callable[[Column, Column], Column], no_rank: Column) -> Column:
    """The merged ranks of an array of the ranks of single bytes.

    A merge writes over the left piece and drops the right one: slices would take most of the time.
    """
    def step(pieces: Column) -> Column:
        def merge(least: Column, at: Column) -> Column:
            return F.filter(F.transform(pieces, lambda piece, i: F.when(i == at, least.cast("int")).when(i != at + 1, piece)),
                            lambda piece: piece.isNotNull())
        ranks = F.transform(pieces, lambda piece, i: pair(piece, F.get(pieces, i + 1)))
        return bound(ranks, lambda r: bound(F.array_min(r), lambda least: F.when(
            least < no_rank, bound(F.array_position(r, least).cast("int") - 1, lambda at: merge(least, at))
        ).otherwise(pieces)))
    return F.aggregate(F.sequence(F.lit(2), F.size(single)), single, lambda pieces, _: step(pieces))


def _fold_string(single: Column, pair: Callable[[Column, Column], Column], no_rank: Column) -> Column:
    """The merged ranks of a long word, kept as one string with each rank in brackets.

    All places of the least pair are merged in a step, from left to right. This is
    what merging one after the other gives, unless a merge makes a pair of lower
    rank; then only the first place is merged.
    """
    def joined(a: Column, b: Column) -> Column:
        return bound(pair(a, b), lambda rank: F.when(rank < no_rank, rank.cast("int")))

    def pieces_of(string: Column) -> Column:
        return F.regexp_extract_all(string, F.lit("[0-9]+"), F.lit(0)).cast("array<int>")

    def seen(string: Column) -> Column:
        """The string with the rank of its least pair and its pieces a and b."""
        def of(pieces: Column) -> Column:
            ranks = F.transform(pieces, lambda piece, i: joined(piece, F.get(pieces, i + 1)))
            return bound(ranks, lambda r: bound(F.array_position(r, F.array_min(r)).cast("int"), lambda i: F.struct(
                string.alias("s"), F.array_min(r).alias("least"), F.get(pieces, i - 1).alias("a"),
                F.get(pieces, i).alias("b"))))
        return bound(pieces_of(string), of)

    def bracketed(*pieces: Column) -> Column:
        return F.concat(*(F.concat(F.lit("["), piece.cast("string"), F.lit("]")) for piece in pieces))

    def step(state: Column) -> Column:
        least = state["least"]
        two, one = bracketed(state["a"], state["b"]), bracketed(least)
        first = F.overlay(state["s"], one, F.instr(state["s"], two), F.length(two))

        def check(new: Column) -> Column:
            between = joined(least, state["a"])
            later = (new["least"].isNull() | (new["least"] > least)) & (between.isNull() | (between > least))
            return F.when(later, new).otherwise(bound(first, seen))
        return F.when(least.isNull(), state).otherwise(
            bound(bound(F.replace(state["s"], two, one), seen), check))

    start = bound(F.concat(F.lit("["), F.array_join(single.cast("array<string>"), "]["), F.lit("]")), seen)
    steps = F.sequence(F.lit(2), F.size(single))
    return pieces_of(F.aggregate(steps, start, lambda s, _: step(s))["s"])


def _single_bytes(data: Column, single: Column) -> Column:
    """The ranks of the single bytes of a binary, read as characters of one byte each."""
    return F.transform(F.split(F.decode(data, "ISO-8859-1"), ""), lambda c: F.get(single, F.ascii(c)))


def fold_bytes(data: Column, vocabulary: Vocabulary) -> Column:
    """The ids that merging the bytes of a word leads to, as an array of int."""
    def merged(pair: Callable[[Column, Column], Column]) -> Column:
        return bound(bound(vocabulary.single, lambda single: _single_bytes(data, single)), lambda s: F.when(
            F.size(s) > LONG_BYTES, _fold_string(s, pair, vocabulary.no_rank)).otherwise(
                _fold_pieces(s, pair, vocabulary.no_rank)))
    return vocabulary.with_pairs(merged)


def fold(word: Column, vocabulary: Vocabulary) -> Column:
    """The ids of one word, as an array of int: that of the whole word if it is a token."""
    def of_bytes(data: Column) -> Column:
        if vocabulary.whole is None:
            return fold_bytes(data, vocabulary)
        entries, buckets = vocabulary.whole
        whole = bound(entries, lambda ranks: lookup_in(ranks, buckets)(F.hex(data)))
        return bound(whole, lambda w: F.when(w.isNotNull(), F.array(w)).otherwise(fold_bytes(data, vocabulary)))
    return bound(F.encode(word, "UTF-8"), of_bytes)


def code(word: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word as little-endian unsigned numbers of 32 bits, one after the other."""
    digits = bound(vocabulary.codes, lambda codes: F.array_join(
        F.transform(fold(word, vocabulary), lambda i: F.get(codes, i)), ""))
    return F.unhex(digits)


def frequent_words(texts: DataFrame, vocabulary: Vocabulary, rows: int = SAMPLE_ROWS,
                   most: int = WORDS) -> DataFrame:
    """(word, code) of at most ``most`` frequent words of about ``rows`` sampled texts."""
    total = texts.count()
    sample = texts.sample(fraction=min(1.0, rows / max(total, 1)), seed=7)
    words = sample.select(F.explode(vocabulary.words(F.col("text"))).alias("word"))
    counts = words.where(F.octet_length("word") <= WORD_BYTES).groupBy("word").agg(F.count("*").alias("n"))
    top = materialize(counts.where("n > 1").orderBy(F.desc("n"), "word").limit(most), "words")
    parts = max(texts.sparkSession.sparkContext.defaultParallelism, top.count() >> 14)
    return materialize(
        top.select("word").repartition(parts).select("word", code(F.col("word"), vocabulary).alias("code")), "codes")


def encode_and_decode(documents: DataFrame, path: str, pattern: str, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """Token ids of each whole text, as the library's ordinary encoding has them, and what they decode to.

    Returns doc_id, n_tokens, code (the ids as little-endian unsigned numbers of 32
    bits) and decoded (bytes) for each input row. Null and empty texts have no ids and
    no bytes; special strings are ordinary text. Repeated rows and null ids give a row
    each, an empty table none; other columns are not read. A text of any length is a
    row, as is its code. The time for a word without a break grows with its length
    times the number of its different merges. ``path`` is a rank file that the driver
    can open.
    """
    vocabulary = Vocabulary(documents.sparkSession, path, pattern)
    key = documents.schema[id_column].dataType.simpleString()
    texts = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    table = frequent_words(texts.select("text"), vocabulary)
    words = texts.withColumn("row", F.monotonically_increasing_id()).select(
        "doc_id", "row", F.explode_outer(vocabulary.words(F.col("text"))).alias("word"))
    own = F.when(F.col("word").isNotNull(), code(F.col("word"), vocabulary))
    codes = words.join(F.broadcast(table.withColumnRenamed("code", "known")), "word", "left").select(
        "doc_id", "row", F.coalesce("known", own).alias("code"))
    pieces = vocabulary.pieces

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = pa.array(pieces.value, pa.binary())

        def decode(ids: bytes) -> bytes:
            found = every.take(pa.array(np.frombuffer(ids, "<u4")))
            return b"" if not len(found) else _data(found)

        def batch_of(keys: list[pa.Array], codes: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(keys), pa.array([len(c) // 4 for c in codes], pa.int64()),
                 pa.array(codes, pa.binary()), pa.array([decode(c) for c in codes], pa.binary())],
                ["doc_id", "n_tokens", "code", "decoded"])

        last, held, begun = -1, None, bytearray()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column(1).to_numpy()
            if rows[0] < last or (np.diff(rows) < 0).any():
                raise RuntimeError("the words of a text do not follow each other")
            starts = np.append(0, np.flatnonzero(np.diff(rows)) + 1).tolist()
            keys, codes = [], []
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                if rows[start] != last:
                    if held is not None:
                        keys.append(held)
                        codes.append(bytes(begun))
                    last, held, begun = rows[start], batch.column(0).slice(start, 1), bytearray()
                begun += _data(batch.column(2).slice(start, end - start))
            if keys:
                yield batch_of(keys, codes)
        if held is not None:
            yield batch_of([held], [bytes(begun)])

    return codes.mapInArrow(assemble, f"doc_id {key}, n_tokens long, code binary, decoded binary")


def _data(array: pa.Array) -> bytes:
    """All values of an array of binaries, one after the other."""
    wide = "i8" if pa.types.is_large_binary(array.type) else "i4"
    offsets = np.frombuffer(array.buffers()[1], wide)[array.offset:array.offset + len(array) + 1]
    return array.buffers()[2][int(offsets[0]):int(offsets[-1])].to_pybytes() if array.buffers()[2] else b""
