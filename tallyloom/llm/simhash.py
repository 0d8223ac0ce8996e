"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most four bits are cut into three segments, one of
which then differs in at most one bit. Each segment is indexed once for every bit
position with that bit wiped out: two segments that differ in at most one bit have
such a variant in common. Variants meet in an equality join, and the difference
of the whole fingerprints is verified there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import components
from tallyloom.plans.lookups import lookup
from tallyloom.plans.storage import materialize

SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4

# (first bit, number of bits) of the segments; one more segment would only do for
# five differing bits, one fewer for three.
SEGMENTS = ((0, 21), (21, 21), (42, 22))


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text, as a signed number; 0 without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(blanks[: len(parts) - words] + 1).tolist()]
        ends = [*blanks[words - 1:].tolist(), len(joined)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends)]
    counts = np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for i in range(0, len(values), 1 << 16):
        part = values[i:i + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) for every row. Bytes A-Z count as lower case; null texts have fp 0."""
    key = documents.schema[id_column].dataType.simpleString()

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py(), words) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return documents.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(compute, f"doc_id {key}, fp long")


def _segment(value: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << width) - 1))


def variants() -> Column:
    """All keys of the column ``fp``: the segment's number and wiped bit, and what is left of it."""
    keys = []
    for s, (first, width) in enumerate(SEGMENTS):
        segment = _segment(F.col("fp"), first, width)
        for bit in range(width):
            left = segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            keys.append(left.bitwiseOR(F.lit((s * 32 + bit) << 32)))
    return F.array(*keys)


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints ``fp`` within ``MOST_BITS`` bits, once each.

    Two fingerprints share many variants. The pair comes from one of them: that of
    the first segment with at most one differing bit, with that bit wiped out, or
    its lowest bit if the segments are equal.

    Spark takes the variants of a fingerprint for one row and would broadcast all of them
    where the fingerprints are small, so both sides are shuffled.
    """
    indexed = prints.select("fp", F.explode(variants()).alias("key"))
    a = indexed.select(F.col("fp").alias("a"), "key")
    b = indexed.select(F.col("fp").alias("b"), "key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    tag = None
    for s, (first, width) in enumerate(SEGMENTS):
        part = _segment(differ, first, width)
        bit = F.when(part == 0, F.lit(0)).otherwise(F.bit_count(part - 1)) + s * 32
        close = F.bit_count(part) <= 1
        tag = F.when(close, bit) if tag is None else tag.when(close, bit)
    return a.join(b.hint("merge"), "key").where(
        (F.col("a") < F.col("b")) & (F.bit_count(differ) <= MOST_BITS)
        & (F.shiftright("key", 32) == tag)).select("a", "b")


def near_duplicates(documents: DataFrame, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """Fingerprint and component of every row: (doc_id, fingerprint, component_id).

    Fingerprints link at ``MOST_BITS`` or fewer differing bits; component_id is the
    smallest doc_id that links reach. Copies share a fingerprint and are joined as
    one. Null and empty texts have fingerprint zero, which links like any other.
    Repeated rows are in the same component; a null id is never the smallest, and a
    component of null ids has none. Other columns are not read.
    """
    prints = materialize(fingerprints(documents, id_column, text_column), "prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = materialize(components(links(distinct.select("fp"))), "roots")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "components")
    return lookup(prints, named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
