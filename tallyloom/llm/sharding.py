"""Contiguous shards whose largest one is as small as whole groups allow.

Rows with equal texts form one group that is never cut. The groups stand in the
order of their text digests; the operator searches the smallest capacity with
which a greedy pass over the group sizes needs no more than the wanted shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import running_totals, utf8_bytes
from tallyloom.plans.storage import materialize

# Bytes that a row costs besides its text.
ROW_BYTES = 8

# How many cells of group ends one step of the search may bring to the driver.
STEP_ENDS = 1 << 16


class GroupEnds:
    """The running totals at which groups end, of which the driver knows some.

    ``ends`` are known ends in order; ``hidden`` tells for each of them whether
    there are unknown ends between it and the one before. A greedy pass over the
    known ends never gets further than the true pass, one that may also stop
    anywhere in a gap with hidden ends never falls behind it. Between the two,
    the search asks Spark for the ends in the gaps that still matter.
    """

    def __init__(self, table: DataFrame, total: int, step_ends: int = STEP_ENDS):
        self.table, self.total, self.step_ends = table, total, step_ends
        self.ends = np.array([total], dtype=np.int64)
        self.hidden = np.array([True])

    def lower(self, capacity: int, shards: int, start: int = 0) -> list[int]:
        at, cuts = start, []
        for _ in range(shards):
            j = int(np.searchsorted(self.ends, at + capacity, "right"))
            at = max(at, int(self.ends[j - 1])) if j else at
            cuts.append(at)
        return cuts

    def upper(self, capacity: int, shards: int) -> list[int]:
        at, cuts = 0, []
        for _ in range(shards):
            j = int(np.searchsorted(self.ends, at + capacity, "right"))
            if j == len(self.ends):
                at = self.total
            elif self.hidden[j]:
                at = at + capacity
            elif j:
                at = max(at, int(self.ends[j - 1]))
            cuts.append(at)
        return cuts

    def _least(self, reaches, low: int, high: int) -> int:
        while low < high:
            middle = (low + high) // 2
            if reaches(middle):
                high = middle
            else:
                low = middle + 1
        return low

    def capacity(self, shards: int) -> int:
        """The smallest capacity with which a greedy pass needs at most ``shards`` shards."""
        while True:
            base = -(-self.total // shards)
            impossible_below = self._least(
                lambda c: self.upper(c, shards)[-1] >= self.total, base, self.total)
            enough = self._least(
                lambda c: self.lower(c, shards)[-1] >= self.total, impossible_below, self.total)
            if impossible_below == enough:
                return enough
            first = self.lower(impossible_below, shards)
            last = self.upper(enough, shards)
            gaps = set()
            for lo, hi in zip(first, last):
                a = int(np.searchsorted(self.ends, lo, "right"))
                b = int(np.searchsorted(self.ends, min(hi + 1, self.total), "left"))
                gaps.update(j for j in range(a, b + 1) if j < len(self.ends) and self.hidden[j])
            self._refine(sorted(gaps))

    def _refine(self, gaps: list[int]) -> None:
        """Learn ends inside the gaps, at most about twice ``step_ends`` of them.

        Of each cell the first and the last end are learned, so every step splits a gap.
        """
        ranges: list[list[int]] = []
        for j in gaps:
            low, high = int(self.ends[j - 1]) if j else 0, int(self.ends[j])
            if ranges and ranges[-1][1] == low:
                ranges[-1][1] = high
            else:
                ranges.append([low, high])
        width = max(1, -(-sum(b - a for a, b in ranges) // self.step_ends))
        place, wanted = F.lit(None).cast("long"), F.lit(False)
        end = F.col("end")
        for low, high in reversed(ranges):
            inside = (end > low) & (end <= high)
            place = F.when(inside, F.floor((end - low - 1) / width) + low).otherwise(place)
            wanted = wanted | inside
        found = (
            self.table.where(wanted).groupBy(place.alias("place"))
            .agg(F.min("end"), F.max("end"), F.count("*")).collect()
        )
        known = {int(e): bool(h) for e, h in zip(self.ends, self.hidden)}
        for j in gaps:
            known[int(self.ends[j])] = False
        for _, first, last, n in found:
            known[last] = n > 2
            known[first] = False
        self.ends = np.array(sorted(known), dtype=np.int64)
        self.hidden = np.array([known[int(e)] for e in self.ends])

    def cuts(self, shards: int) -> list[int]:
        """Shard ends: no shard above the smallest capacity, each cut near its even share."""
        limit, at, cuts = self.capacity(shards), 0, []
        for i in range(1, shards):
            rest = shards - i

            def fits(j: int) -> bool:
                return self.lower(limit, rest, int(self.ends[j]))[-1] >= self.total

            last = int(np.searchsorted(self.ends, at + limit, "right")) - 1
            if last < 0 or self.ends[last] <= at:
                cuts.append(at)
                continue
            first = int(np.searchsorted(self.ends, at, "right"))
            least = self._least(fits, first, last)
            even = at + (self.total - at) / (rest + 1)
            near = int(np.searchsorted(self.ends, even, "left"))
            choice = min((j for j in (near - 1, near) if first <= j < len(self.ends)),
                         key=lambda j: abs(self.ends[j] - even), default=last)
            at = int(self.ends[min(max(choice, least), last)])
            cuts.append(at)
        return [*cuts, self.total]


def shard(documents: DataFrame, shards: int = 24, id_column: str = "doc_id",
          text_column: str = "text", step_ends: int = STEP_ENDS) -> DataFrame:
    """Put all rows into shards 0 to ``shards`` - 1 with sizes as even as groups allow.

    Returns one row per input row: the id, size (UTF-8 bytes of the text plus 8),
    text_crc32, law "bytes", shard, slot and an empty grown_shard. Slots run from 0
    without a gap in every shard, in the order of (digest, id).

    Null texts have size 8, no checksum, and form one group; an empty text is
    another group. Repeated rows each get a slot, in the same shard. A null id is
    an id like any other. With fewer groups than shards some shards stay empty, an
    empty table gives no rows. Other columns are not read. Only sizes and digests
    are shuffled, never texts, and a group of any size is split over partitions.
    """
    text = F.col(text_column).cast("binary")
    rows = materialize(documents.select(
        F.col(id_column).alias("id"),
        (utf8_bytes(text_column) + ROW_BYTES).alias("size"),
        F.crc32(text).alias("crc"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    ), "sizes")
    order = ["digest", "id", "row"]
    placed = running_totals(rows.repartitionByRange(*order).sortWithinPartitions(*order), "size")
    total = placed.agg(F.max("end")).first()[0] or 0
    group_ends = materialize(placed.groupBy("digest").agg(F.max("end").alias("end")).select("end"),
                             "ends")
    cuts = GroupEnds(group_ends, total, step_ends).cuts(shards) if total else [0] * shards
    before = F.array(*(F.lit(c).cast("long") for c in cuts[:-1])) if shards > 1 else F.array().cast("array<bigint>")
    sharded = placed.withColumn("shard", F.size(F.filter(before, lambda c: c < F.col("end"))))
    starts = sharded.groupBy("shard").agg(F.min("index").alias("start"))
    return sharded.join(F.broadcast(starts), "shard").select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("index") - F.col("start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
