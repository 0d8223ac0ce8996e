"""Removal of 50-byte strings that also start in an earlier document.

A suffix array sorts all suffixes; to find repeats of a fixed length, the first
buckets and one refinement are enough, and only where buckets are shared:

1. Every position has a bucket, the hash of its 25 bytes. Of the 26 buckets in a
   50-byte string the least marks an anchor, so equal strings have equal anchors.
   Only anchors are sorted, about one position in fourteen.
2. An anchor's bucket is refined by the buckets 25 bytes before and after it; the
   three cover all strings that the anchor can stand for. Sorted by (bucket,
   refined bucket, document), an anchor whose refined bucket began in an earlier
   document has all its bytes repeated.
3. What is left of a bucket that several documents share is one anchor for each
   refined bucket. Its 50-byte strings are refined on their own by the buckets at
   their start and 25 bytes later, the same buckets used again, and sorted likewise.

A bucket and its refinement are held in 106 bits, so that strings in one are taken as equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import small_side
from tallyloom.operators.ordinals import with_ordinals
from tallyloom.plans.storage import materialize

STRING_BYTES = 50
GRAM = 25
GRAMS = STRING_BYTES - GRAM + 1

# Bytes of text that are hashed at once, and anchors that a task holds before it
# drops what it has seen in an earlier document of its own.
BUFFER_BYTES = 1 << 18
HELD_ANCHORS = 1 << 20

# Contexts of anchors that are taken apart at once.
HELD_CONTEXTS = 1 << 15

# The packed place of an anchor: the number of its text among the different texts of one
# doc_id (22 bits), its position (31), the bytes of context before and after it (5 each).
# Until it is sorted, the number, or tag, is in the last bits of the refined bucket.
TAG_BITS, TAG_SHIFT, POSITION_SHIFT = 22, 41, 10
TAG_MASK = (1 << TAG_BITS) - 1

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xC2B2AE3D27D4EB4F)
_K3 = np.uint64(0x165667B19E3779F9)


def _buckets(data: np.ndarray) -> np.ndarray:
    """A 64-bit bucket, never 0, of the 25 bytes at each position of an array of bytes."""
    n = len(data) - GRAM + 1
    word = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    x = word[:n] * _K1
    x ^= x >> np.uint64(29)
    x += word[8:8 + n]
    x *= _K2
    x ^= x >> np.uint64(32)
    x += word[16:16 + n]
    x *= _K3
    x ^= x >> np.uint64(29)
    x += data[24:24 + n]
    x *= _K1
    x ^= x >> np.uint64(32)
    x *= _K2
    x ^= x >> np.uint64(29)
    x |= np.uint64(1)
    return x


def _tagged(refined: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """The refined bucket, its last bits replaced by the tag of the text."""
    return (refined.view(np.int64) & ~TAG_MASK) | tag


def _refine(before: np.ndarray, at: np.ndarray, after: np.ndarray) -> np.ndarray:
    x = before * _K3
    x ^= x >> np.uint64(31)
    x += at
    x *= _K1
    x ^= x >> np.uint64(29)
    x += after
    x *= _K2
    x ^= x >> np.uint64(32)
    return x


def _slide(values: np.ndarray, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over windows of GRAMS values, by doubling."""
    span = 1
    while 2 * span <= GRAMS:
        values = choose(values[:-span], values[span:])
        span *= 2
    rest = GRAMS - span
    return choose(values[:-rest], values[rest:]) if rest else values


class Buffer:
    """Texts, or parts of long ones, that are hashed together."""

    def __init__(self):
        self.data = bytearray()
        self.parts: list[tuple[int, int, int, int, int, int, int]] = []

    def add(self, data: bytes, low: int, high: int, first: int, last: int, doc: int, tag: int):
        """Bytes low..high of a text, with strings that start at first..last (excluded)."""
        self.parts.append((len(self.data), low, first - low, last - low, doc, tag, len(data)))
        self.data += data[low:high]

    def anchors(self) -> tuple[np.ndarray, ...]:
        """(bucket, refined, document, place) of all anchors."""
        data = np.frombuffer(bytes(self.data), np.uint8)
        starts, lows, firsts, lasts, docs, tags, sizes = np.array(self.parts, np.int64).T
        bucket = _buckets(data)
        least = _slide(bucket, np.minimum)
        edges = np.zeros(len(least) + 1, np.int8)
        np.add.at(edges, starts + firsts, 1)
        np.add.at(edges, starts + lasts, -1)
        least[np.cumsum(edges[:-1]) == 0] = 0
        pad = np.zeros(GRAMS - 1, np.uint64)
        most = _slide(np.concatenate([pad, least, pad]), np.maximum)
        at = np.flatnonzero(most == bucket)
        part = np.searchsorted(starts, at, "right") - 1
        position = at - starts[part] + lows[part]
        before = np.minimum(GRAM, position)
        after = np.minimum(GRAM, sizes[part] - position - GRAM)
        g = bucket[at]
        c = _refine(bucket[at - before] + before.astype(np.uint64), g,
                    bucket[at + after] + after.astype(np.uint64) * _K3)
        place = (position << POSITION_SHIFT) | (before << 5) | after
        return g.view(np.int64), _tagged(c, tags[part]), docs[part], place


def _held_apart(found: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """Anchors of a task; those whose refined bucket an earlier document of the task has
    are settled: they go on without a bucket."""
    if not found:
        return
    g, c, doc, place = (np.concatenate(x) for x in zip(*found))
    key = _refine(g.view(np.uint64), (c >> TAG_BITS).view(np.uint64), _K1)
    order = np.argsort(key)
    g, c, doc, place, key = g[order], c[order], doc[order], place[order], key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    least = np.repeat(np.minimum.reduceat(doc, new), np.diff(np.append(new, len(key))))
    later = doc > least
    yield from _rows(["g", "c", "doc", "place"], [pa.array(g, mask=later), pa.array(c),
                                                  pa.array(doc), pa.array(place)])


def _rows(names: list[str], columns: list[pa.Array], most: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names)
    for a in range(0, whole.num_rows, most):
        yield whole.slice(a, most)


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    buffer, count = Buffer(), 0
    for batch in batches:
        for doc, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = (text.as_py() or "").encode()
            last = len(data) - STRING_BYTES + 1
            for first in range(0, max(0, last), BUFFER_BYTES):
                end = min(first + BUFFER_BYTES, last)
                buffer.add(data, max(0, first - GRAM), min(len(data), end + STRING_BYTES + GRAM),
                           first, end, doc, tag)
                if len(buffer.data) >= BUFFER_BYTES:
                    held.append(buffer.anchors())
                    count, buffer = count + len(held[-1][0]), Buffer()
            if count >= HELD_ANCHORS:
                yield from _held_apart(held)
                held, count = [], 0
    if buffer.parts:
        held.append(buffer.anchors())
    yield from _held_apart(held)


def _strings_at(grid: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """The 50-byte strings of anchors, given their bytes in context, one row for each anchor.

    They are anchors with no context before; each is due to the anchor that is its least bucket.
    """
    n, width = grid.shape
    bucket = _buckets(np.append(grid.reshape(-1), np.zeros(GRAM, np.uint8)))
    bucket = bucket[:n * width].reshape(n, width)[:, :width - GRAM + 1]
    least, span = bucket, 1
    while 2 * span <= GRAMS:
        least, span = np.minimum(least[:, :-span], least[:, span:]), 2 * span
    least = np.minimum(least[:, :span - GRAMS], least[:, GRAMS - span:])
    before, after = (place >> 5) & 31, place & 31
    position, tag = (place >> POSITION_SHIFT) & 0x7FFFFFFF, place >> TAG_SHIFT
    own = bucket[np.arange(n), before]
    first = np.arange(least.shape[1])
    inside = (least == own[:, None]) & (first <= before[:, None]) & (
        before[:, None] <= first + GRAMS - 1) & (first + STRING_BYTES <= (before + GRAM + after)[:, None])
    row, s = np.nonzero(inside)
    g = own[row]
    c = _tagged(_refine(bucket[row, s], g, bucket[row, s + GRAM]), tag[row])
    start = position[row] - before[row] + s
    return g.view(np.int64), c, doc[row], (start << POSITION_SHIFT) | GRAM


def _find_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Strings of the wanted anchors, many texts at once."""
    steps = np.arange(3 * GRAM)
    grids, docs, places, count = [], [], [], 0
    for batch in batches:
        for doc, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = (text.as_py() or "").encode()
            place = wanted.values.to_numpy(zero_copy_only=False)
            source = np.frombuffer(data + bytes(3 * GRAM), np.uint8)
            for a in range(0, len(place), HELD_CONTEXTS):
                some = place[a:a + HELD_CONTEXTS]
                start = ((some >> POSITION_SHIFT) & 0x7FFFFFFF) - ((some >> 5) & 31)
                grids.append(source[start[:, None] + steps])
                docs.append(np.full(len(some), doc, np.int64))
                places.append(some)
                count += len(some)
                if count >= HELD_CONTEXTS:
                    yield _strings_at(np.concatenate(grids), np.concatenate(docs), np.concatenate(places))
                    grids, docs, places, count = [], [], [], 0
    if count:
        yield _strings_at(np.concatenate(grids), np.concatenate(docs), np.concatenate(places))


def _apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches joined to larger ones, and anchors already seen in the task settled."""
    held, count = [], 0
    for found in _find_strings(batches):
        held.append(found)
        count += len(found[0])
        if count >= HELD_ANCHORS:
            yield from _held_apart(held)
            held, count = [], 0
    yield from _held_apart(held)


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (g, c, doc): repeated places (open false), and places that stand
    for a refined bucket in a bucket of several documents (open true)."""
    names = ["doc", "place", "open"]
    last_g = last_c = first_doc = owner = None
    shared, waiting = False, []

    def rows(doc, place, is_open):
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(place), pa.array(np.full(len(doc), is_open))], names)

    for batch in batches:
        bare = batch.column(0).null_count
        if bare:
            settled = batch.filter(batch.column(0).is_null())
            c, doc, place = (settled.column(i).to_numpy() for i in (1, 2, 3))
            yield rows(doc, place | ((c & TAG_MASK) << TAG_SHIFT), False)
            batch = batch.filter(batch.column(0).is_valid())
        if not batch.num_rows:
            continue
        g, c, doc, place = (batch.column(i).to_numpy() for i in range(4))
        place = place | ((c & TAG_MASK) << TAG_SHIFT)
        c = c >> TAG_BITS
        new_g = np.concatenate([[g[0] != last_g], g[1:] != g[:-1]])
        new_c = new_g | np.concatenate([[c[0] != last_c], c[1:] != c[:-1]])
        starts = np.flatnonzero(np.concatenate([[True], new_c[1:]]))
        firsts = doc[starts]
        if not new_c[0]:
            firsts[0] = first_doc
        begun = np.repeat(firsts, np.diff(np.append(starts, len(doc))))
        later = doc != begun
        if later.any():
            yield rows(doc[later], place[later], False)
        # One owner for each refined bucket is left; a bucket is shared if they differ.
        runs = np.flatnonzero(np.concatenate([[True], new_g[1:]]))
        low, high = np.minimum.reduceat(begun, runs), np.maximum.reduceat(begun, runs)
        several = low != high
        if not new_g[0]:
            several[0] |= shared or low[0] != owner
        if waiting and (new_g[0] or several[0]):
            if not new_g[0]:
                for held in waiting:
                    yield rows(*held, True)
            waiting = []
        opened = np.repeat(several, np.diff(np.append(runs, len(doc)))) & ~later
        if opened.any():
            yield rows(doc[opened], place[opened], True)
        if not several[-1]:
            tail = np.arange(len(doc)) >= runs[-1]
            tail &= ~later
            if len(runs) > 1:
                waiting = []
            waiting.append((doc[tail], place[tail]))
        elif len(runs) > 1:
            waiting = []
        last_g, last_c, first_doc, owner = g[-1], c[-1], begun[-1], low[-1]
        shared = bool(several[-1])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From places sorted by document and tag: the maximal removed runs of each text, as pairs of bytes."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def emit(doc, place):
        text = place >> TAG_SHIFT
        position = (place >> POSITION_SHIFT) & 0x7FFFFFFF
        start = position - ((place >> 5) & 31)
        end = position + GRAM + (place & 31)
        order = np.lexsort((start, text, doc))
        doc, text, start, end = doc[order], text[order], start[order], end[order]
        # Runs: the furthest end so far, kept apart for each text by an offset.
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])])
        level = np.cumsum(new) << 32
        reach = np.maximum.accumulate(end + level)
        begin = np.concatenate([[True], (start + level)[1:] > reach[:-1]])
        at = np.flatnonzero(begin)
        stop = np.append(at[1:], len(doc)) - 1
        starts, ends = start[at], reach[stop] - level[stop]
        texts = np.flatnonzero(new)
        bounds = np.searchsorted(at, np.append(texts, len(doc)))
        pairs = np.stack([starts, ends], 1).astype("<i4")
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[texts]), pa.array(text[texts].astype(np.int32)),
             pa.array([pairs[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())],
            ["doc", "tag", "runs"])

    def emit_held():
        yield emit(*(np.concatenate(x) for x in zip(*held)))
        held.clear()

    for batch in batches:
        doc, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(doc):
            continue
        text = place >> TAG_SHIFT
        # The last text may go on in the next batch; it is joined once, when it ends.
        cut = int(np.flatnonzero((doc != doc[-1]) | (text != text[-1]))[-1]) + 1 if (
            (doc != doc[-1]) | (text != text[-1])).any() else 0
        if held and (cut or doc[0] != held[-1][0][-1] or text[0] != held[-1][1][-1] >> TAG_SHIFT):
            if cut:
                held.append((doc[:cut], place[:cut]))
                doc, place = doc[cut:], place[cut:]
            yield from emit_held()
        elif cut:
            yield emit(doc[:cut], place[:cut])
            doc, place = doc[cut:], place[cut:]
        held.append((doc, place))
    if held:
        yield from emit_held()


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for text, runs in zip(batch.column(1), batch.column(2)):
            data, removed, spans = (text.as_py() or "").encode(), 0, 0
            kept, at = hashlib.sha256(), 0
            if runs.is_valid:
                for start, end in np.frombuffer(runs.as_py(), "<i4").reshape(-1, 2).tolist():
                    kept.update(data[at:start])
                    removed, spans, at = removed + end - start, spans + 1, end
            kept.update(data[at:])
            for column, value in zip(out, (len(data), removed, spans, kept.hexdigest())):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.string())],
            names)


_ANCHOR = "g long, c long, doc long, place long"
_PLACE = "doc long, place long, open boolean"


def _sort_buckets(anchors: DataFrame) -> DataFrame:
    to = F.coalesce("g", F.xxhash64("doc", "place"))
    order = ["g", F.shiftright("c", TAG_BITS), "doc"]
    return anchors.repartition(to).sortWithinPartitions(*order).mapInArrow(_sorted_runs, _PLACE)


def _with_tags(rows: DataFrame) -> DataFrame:
    """The rows (doc, text) with ``tag``, the number of the text among the different ones of its id.

    Only texts of ids that repeat are told apart, by their SHA-256, and numbered in one
    order over all of them, so that no task gathers the texts of an id.
    """
    counts = rows.where("doc is not null").groupBy("doc").agg(F.count("*").alias("n"))
    repeated = materialize(counts.where("n > 1").select("doc"), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("tag", F.lit(0).cast("long"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    texts = rows.join(small_side(repeated), "doc", "left_semi").select("doc", digest.alias("digest")).distinct()
    numbered = materialize(with_ordinals(texts, "doc", "digest"), "numbered")
    firsts = materialize(numbered.groupBy("doc").agg(F.min("ordinal").alias("first")), "firsts")
    tags = materialize(numbered.join(small_side(firsts), "doc").select(
        "doc", "digest", (F.col("ordinal") - F.col("first")).alias("tag")), "tags")
    if tags.agg(F.max("tag")).first()[0] > TAG_MASK:
        raise ValueError(f"more than {TAG_MASK + 1} different texts have one id")
    return rows.withColumn("digest", digest).join(small_side(tags), ["doc", "digest"], "left").select(
        "doc", "text", F.coalesce("tag", F.lit(0)).alias("tag"))


def remove_repeats(documents: DataFrame, id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """Remove each byte covered by a 50-byte string that also starts in an earlier document.

    Earlier means a smaller integer id. Returns doc_id, n_bytes (UTF-8), n_removed,
    n_spans (maximal removed runs) and kept_sha256 (of the bytes that are left) for
    each row. Strings never cross documents, overlap freely, and are judged on the
    input. A null text is empty. Rows with the same id are not earlier than one
    another, however many there are (up to four million different texts of one id;
    more are refused). A row without id is kept whole and does not count as a source. Texts of
    under 50 bytes are kept. Other columns are not read; an empty table gives no rows.
    """
    rows = _with_tags(documents.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text")))
    named = rows.where("doc is not null").select("doc", "tag", "text")
    first = materialize(_sort_buckets(named.mapInArrow(_find_anchors, _ANCHOR)), "places")
    tag = F.shiftright("place", TAG_SHIFT).alias("tag")
    wanted = materialize(
        first.where("open").groupBy("doc", tag).agg(F.collect_list("place").alias("places")), "wanted")
    strings = named.join(small_side(wanted), ["doc", "tag"]).select("doc", "text", "places").mapInArrow(
        _apart, _ANCHOR)
    second = materialize(_sort_buckets(strings).where("not open"), "strings")
    repeated = first.where("not open").select("doc", "place").unionByName(second.select("doc", "place"))
    runs = materialize(
        repeated.repartition(F.col("doc"), tag).sortWithinPartitions("doc", tag)
        .mapInArrow(_merged, "doc long, tag int, runs binary"), "runs")
    removed = runs.withColumn("tag", F.col("tag").cast("long"))
    return (
        rows.join(small_side(removed), ["doc", "tag"], "left").select("doc", "text", "runs")
        .mapInArrow(_strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    )
