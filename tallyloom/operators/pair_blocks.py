"""Pairs of ids that meet in rows, counted in blocks of the id by id matrix.

Ids fall into groups by their remainder, and two groups are a block. Each id is written once,
to its group's place of a shuffle, row by row and in as few bytes as it needs. A task reads
two such places and counts all pairs of half a block, that of the even or of the odd ids on
one side; a block of one group is not halved. So ids on disk do not grow with the groups,
which are as many as a task's memory or the cluster's cores ask for.

What runs in tasks is defined inside of functions, so that it travels whole and executors
need no copy of this package.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of ids, two each, that the task of a block holds.
BLOCK_BYTES = 128 << 20

# Pairs, and cells of a dense count, that a task has in memory at a time.
PASS_PAIRS = 1 << 21

ROWS_RETURNED = 1 << 17

# Ids of whole rows that are cut into one piece for each group.
PIECE_IDS = 1 << 20

_PIECE = "batch bigint, part int, counts binary, counts_width int, ids binary, ids_width int"


def groups_for(ids: int, cores: int) -> int:
    """Into how many groups ids that occur so often are split, for blocks that are
    no larger than a task holds and twice as many as the cores."""
    return max(math.ceil(4 * ids / BLOCK_BYTES), math.ceil(math.sqrt(4 * cores + 0.25) - 0.5), 1)


def _whole_lines(enough: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, pa.Table]]]:
    """What makes of rows, whose first column is their line, tables of whole lines with at
    least so many rows, and the place of each row's line in its table."""

    def numbered(table: pa.Table) -> tuple[np.ndarray, pa.Table]:
        line = table.column(0).to_numpy()
        return np.cumsum(np.diff(line, prepend=line[0]) != 0), table

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Table]]:
        held, size, most = [], 0, enough
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= most:
                table = pa.Table.from_batches(held)
                starts = np.flatnonzero(np.diff(table.column(0).to_numpy())) + 1
                end = int(starts[-1]) if len(starts) else 0
                if end:
                    yield numbered(table.slice(0, end))
                held, size = table.slice(end).to_batches(), size - end
                most = max(enough, 2 * size)
        if size:
            yield numbered(pa.Table.from_batches(held))

    return whole


def gathered(rows: DataFrame, line: str, ids: str, words: str) -> DataFrame:
    """(line, ids, words): what of either is not null in the rows of a line, which are next to
    each other in one partition. Nothing is shuffled."""
    whole = _whole_lines(PIECE_IDS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, table in whole(batches):
            lists = []
            for column in table.columns[1:]:
                there = column.is_valid().to_numpy()
                ends = np.cumsum(np.bincount(row[there], minlength=int(row[-1]) + 1))
                values = pa.concat_arrays(column.drop_null().chunks or [pa.array([], column.type)])
                lists.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), values))
            first = np.flatnonzero(np.diff(row, prepend=-1))
            yield pa.RecordBatch.from_arrays([pa.array(table.column(0).to_numpy()[first]), *lists], [line, ids, words])

    return rows.select(line, ids, words).mapInArrow(
        gather, f"{line} bigint, {ids} array<int>, {words} array<string>")


def pieces(rows: DataFrame, ids: str, groups: int, line: str | None = None) -> DataFrame:
    """For each batch of rows and each group: how many ids of the group a row has, and these
    ids, sorted and divided by the number of groups. Ids are not negative and distinct in a row.

    ``ids`` is a column of arrays or, with ``line``, of single ids: those of a line are then
    next to each other in one partition. A batch has whole rows.
    """
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.int32()]
    names = [column.split()[0] for column in _PIECE.split(", ")]
    whole = _whole_lines(PIECE_IDS)

    def packed(values: np.ndarray) -> tuple[bytes, int]:
        """All lowest bytes, then all next ones: few are above zero there."""
        width = max(1, math.ceil(int(values.max()).bit_length() / 8))
        return b"".join((values >> 8 * k).astype(np.uint8).tobytes() for k in range(width)), width

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The row of each id, and the ids."""
        before = 0
        for batch in batches:
            lists = batch.column(0)
            row = np.repeat(np.arange(len(lists)) + before, lists.value_lengths().to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(row), lists.flatten()], names=["row", "id"])
            before += len(lists)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (row, table) in enumerate(whole(batches if line else flat(batches))):
            found = table.column(1).to_numpy().astype(np.int64)
            rows, above = int(row[-1]) + 1, int(found.max()) + 1
            row, found = np.divmod(np.sort(row * above + found), above)
            part = found % groups
            order = np.argsort(part, kind="stable")
            ends = np.cumsum(np.bincount(part, minlength=groups))[:-1]
            cuts = []
            for at, (own, own_row) in enumerate(zip(np.split(found[order] // groups, ends), np.split(row[order], ends))):
                if len(own):
                    counts = np.bincount(own_row, minlength=rows)
                    cuts.append(((task << 32) + number, at, *packed(counts), *packed(own)))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*cuts), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(*[line] if line else [], ids).mapInArrow(cut, _PIECE)


def _counter(groups: int, least: int, named: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What counts a block, or half of it. A part is the ids of its two groups in one batch of
    rows: left ids and the ends of their rows, right ids, the ends and the sizes of their rows.
    In a block of one group, an id meets those before it in its row. If ``named``, a row
    without a part has the names of the two groups."""
    most, returned = PASS_PAIRS, ROWS_RETURNED

    def unpacked(values: pa.BinaryScalar, width: int) -> np.ndarray:
        kind = (np.uint8, np.uint16, np.uint32, np.uint32)[width - 1]
        every = np.frombuffer(values.as_buffer(), np.uint8).reshape(width, -1)
        found = np.zeros(every.shape[1], kind)
        for k, part in enumerate(every):
            found |= part.astype(kind) << 8 * k
        return found

    def met(part: tuple, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the partners of entries of the left group begin, and how many they are."""
        left, left_ends, right, right_ends, sizes = part
        row = np.searchsorted(left_ends, entries, "right")
        start = right_ends[row].astype(np.int64) - sizes[row]
        return start, entries - start if left is right else sizes[row].astype(np.int64)

    def keys(part: tuple, first: int, end: int, width: int) -> Iterator[np.ndarray]:
        """A number for each pair whose left id is in the range, in portions of a pass."""
        left, right = part[0], part[2]
        entries = np.flatnonzero((left >= first) & (left < end))
        start, n = met(part, entries)
        for some in np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // most)) + 1):
            many = n[some]
            ends = np.cumsum(many)
            if len(ends) and ends[-1]:
                at = np.arange(ends[-1]) + np.repeat(start[some] - ends + many, many)
                yield np.repeat((left[entries[some]].astype(np.int64) - first) * width, many) + right[at]

    def counted(parts: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(left id, right id, n). The left ids are taken in ranges: of few pairs, which are
        sorted, or of few cells, in which any number of pairs is counted."""
        owners, width = (1 + max(int(part[at].max()) for part in parts) for at in (0, 2))
        upto = np.zeros(owners + 1, np.int64)
        for part in parts:
            _, n = met(part, np.arange(len(part[0])))
            upto[1:] += np.bincount(part[0], n, owners).astype(np.int64)
        upto = np.cumsum(upto)
        first = 0
        while first < owners:
            few = int(np.searchsorted(upto, upto[first] + most, "right")) - 1
            end = min(owners, max(few, first + max(1, most // width)))
            pairs = upto[end] - upto[first]
            dense = pairs > most
            sums = np.zeros((end - first) * width if dense else 0, np.int64)
            held, size = [np.zeros(0, np.int64)], 0
            for part in parts if pairs else ():
                for some in keys(part, first, end, width):
                    held.append(some)
                    size += len(some)
                    if dense and size > most:
                        sums += np.bincount(np.concatenate(held), minlength=len(sums))
                        held, size = [np.zeros(0, np.int64)], 0
            every = np.concatenate(held)
            if dense:
                sums += np.bincount(every, minlength=len(sums))
                pair = np.flatnonzero(sums >= least)
                n = sums[pair]
            else:
                every.sort()
                starts = np.flatnonzero(np.diff(every, prepend=-1))
                n = np.diff(starts, append=len(every))
                pair, n = every[starts][n >= least], n[n >= least]
            if len(n):
                yield pair // width + first, pair % width, n
            first = end

    def met_rows(own: np.ndarray, own_sizes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple | None:
        """A part of the rows that have ids on both sides."""
        both = (own_sizes > 0) & (sizes > 0)
        if not both.any():
            return None
        own, ids = own[np.repeat(both, own_sizes)], ids[np.repeat(both, sizes)]
        sizes = sizes[both]
        return (own, np.cumsum(own_sizes[both], dtype=np.int32), ids, np.cumsum(sizes, dtype=np.int32), sizes)

    def alone(own: np.ndarray, sizes: np.ndarray) -> tuple | None:
        """A part of a block of one group, of the rows with several ids."""
        several = sizes > 1
        if not several.any():
            return None
        own, sizes = own[np.repeat(several, sizes)], sizes[several]
        ends = np.cumsum(sizes, dtype=np.int32)
        return own, ends, own, ends, sizes

    def halved(own: np.ndarray, sizes: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
        """The even or the odd ids, divided by two."""
        row = np.repeat(np.arange(len(sizes)), sizes)
        wanted = own & 1 == half
        return own[wanted] >> 1, np.bincount(row[wanted], minlength=len(sizes))

    def names_of(groups_names: dict[int, tuple], low: int, high: int) -> Callable[[np.ndarray], list]:
        """What gives names and their numbers of ids of the two groups."""
        both = [groups_names[low], groups_names[high]]
        names = pa.concat_arrays([name for _, name, _ in both])
        numbers = np.concatenate([n for _, _, n in both])

        def look(ids: np.ndarray) -> list:
            at = np.where(ids % groups == low, np.searchsorted(both[0][0], ids),
                          len(both[0][0]) + np.searchsorted(both[1][0], ids))
            return [names.take(pa.array(at)), pa.array(numbers[at])]

        return look

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, low, high, half, step, known = [], 0, 0, 0, 1, {}
        for batch in batches:
            for at in range(batch.num_rows):
                first, second, *sides = [column[at] for column in batch.columns]
                low, high = first.as_py(), second.as_py()
                if named and sides[8].is_valid:
                    for group, found in ((low, sides[8].values), (high, sides[9].values)):
                        ids, names, numbers = found.flatten()
                        known[group] = ids.to_numpy(), names, numbers.to_numpy()
                    continue
                left, right = [(unpacked(ids, width.as_py()), unpacked(sizes, sizes_width.as_py()))
                               for sizes, sizes_width, ids, width in (sides[:4], sides[4:8])]
                if low == high:
                    part = alone(*left)
                else:
                    if low > high:
                        left, right = right, left
                    part = met_rows(*halved(*left, int(low > high)), *right)
                if part:
                    parts.append(part)
        if low != high:
            half, step = int(low > high), 2
            low, high = min(low, high), max(low, high)
        look = names_of(known, low, high) if named and parts else None
        for own, other, n in counted(parts) if parts else ():
            own, other = (own * step + half) * groups + low, other * groups + high
            for at in range(0, len(n), returned):
                some = slice(at, at + returned)
                a, b = np.minimum(own[some], other[some]), np.maximum(own[some], other[some])
                columns = [pa.array(a), pa.array(b), pa.array(n[some])]
                if look:
                    columns += look(a) + look(b)
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "nxy", "x", "nx", "y", "ny"][:len(columns)])

    return count


def pair_counts(rows: DataFrame, ids: str, groups: int, least: int = 1, line: str | None = None,
                names: DataFrame | None = None) -> DataFrame:
    """(a, b, nxy) with a < b: the number of rows that hold both ids, if it is at least ``least``.

    ``ids`` and ``line`` are as for ``pieces``. A group is one partition of one shuffle, and a
    task reads two of them, so that nothing is added up after it. ``names`` (id, w, n), of all
    ids, go with their groups and add (x, nx, y, ny) to the pairs, which are not shuffled for it.
    """
    dealt, sides = pieces(rows, ids, groups, line), ["counts", "counts_width", "ids", "ids_width"]
    if names is not None:
        # One row for each group, met by that of the other group, as pieces of a batch are.
        named = names.groupBy((F.col("id") % groups).cast("int").alias("part")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("id").cast("bigint"), "w", "n"))).alias("names"))
        dealt = dealt.unionByName(named.withColumn("batch", F.lit(-1).cast("bigint")), allowMissingColumns=True)
        sides = [*sides, "names"]
    dealt = dealt.repartitionById(groups, F.col("part"))
    left, right = (dealt.select(*(F.col(c).alias(f"{c}_{k}") for c in ("batch", "part", *sides))) for k in "lr")
    # By this hint, a task is a pair of partitions; else both sides were shuffled again.
    met = left.join(right.hint("shuffle_replicate_nl"), F.col("batch_l") == F.col("batch_r")).select(
        "part_l", "part_r", *(f"{c}_{k}" for k in "lr" for c in sides[:4]), *(f"{c}_{k}" for c in sides[4:] for k in "lr"))
    more = "" if names is None else ", x string, nx bigint, y string, ny bigint"
    return met.mapInArrow(_counter(groups, least, names is not None), "a bigint, b bigint, nxy bigint" + more)


def cells(rows: DataFrame, gathered: list[str]) -> DataFrame:
    """(x, part, nx) and arrays of the gathered columns: one row for those of many that agree in
    x and part, which so have few bytes to shuffle."""
    columns = ["x", "part", "nx", *gathered]
    kinds = dict(rows.dtypes)
    enough = PIECE_IDS

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= enough:
                yield lists(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield lists(pa.Table.from_batches(held))

    def lists(table: pa.Table) -> pa.RecordBatch:
        code = table.column("x").combine_chunks().dictionary_encode()
        x, part = code.indices.to_numpy(), table.column("part").to_numpy()
        order = np.lexsort((part, x))
        x, part = x[order], part[order]
        first = np.flatnonzero((np.diff(x, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
        ends = pa.array(np.append(first, len(x)), pa.int32())
        sorted_rows = table.select(columns[2:]).take(pa.array(order)).combine_chunks()
        nx, *others = (pa.concat_arrays(column.chunks) for column in sorted_rows.columns)
        return pa.RecordBatch.from_arrays(
            [code.dictionary.take(pa.array(x[first])), pa.array(part[first]), nx.take(pa.array(first)),
             *(pa.ListArray.from_arrays(ends, other) for other in others)], names=columns)

    return rows.select(*columns).mapInArrow(gather, ", ".join(
        [f"{c} {kinds[c]}" for c in columns[:3]] + [f"{c} array<{kinds[c]}>" for c in gathered]))
