"""Repair of the structure of conversations by a Viterbi search over edits.

A conversation's roles must read as a system turn, if any, and then user and assistant
in turns, or as nothing at all. Every row is kept, given another role or deleted, and
empty rows may be inserted; the cheapest edits win, of equally cheap ones those whose
initials come first in ASCII order.

The search goes over the rows in order with one survivor for each state of the pattern.
Survivors are leaves of a tree of back pointers that counts references: a branch that no
survivor needs is dropped, and the edits above the last ancestor that all survivors
share are emitted, so memory holds only what is not settled, at most the rows of a task.
A survivor that another one beats whatever follows is given up. Survivors of equal cost
are compared from their last common ancestor on, over all that is not settled.

A long conversation is spread over tasks. Rows are range partitioned in order, so a task
holds a stretch of rows, and only its first and its last conversation can go on in
another one. The first pass gives for those, from each state at the beginning, the cost
and the rank among equals of each state at the end: a few numbers for each task, which
the driver chains to the states at the seams. In the second pass every stretch is
searched between its states. Insertions at a seam belong to the later stretch, so that
the edits of a stretch, which then end with a row, are never a beginning of each other.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.plans.storage import materialize

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
ACCEPTED = (START, ASSISTANT)

# Where a row of the role's initial leads to; other initials cannot be kept.
KEEP = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
# The state after the one row that may be given any of the two roles, or be inserted.
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
ROLES = {USER: "user", ASSISTANT: "assistant"}

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

# After how many rows the tree is asked for what is settled.
SETTLE_ROWS = 64


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class _Node:
    """An edit in the tree of back pointers. ``at`` is the row, or None for an insertion."""

    __slots__ = ("edit", "at", "state", "parent", "depth", "children")

    def __init__(self, edit, at, state, parent):
        self.edit, self.at, self.state, self.parent = edit, at, state, parent
        self.depth = parent.depth + 1 if parent else 0
        self.children = 0
        if parent:
            parent.children += 1


def _release(node: _Node) -> None:
    """Drop a node that nothing refers to, and what only it referred to."""
    while node.parent is not None and not node.children:
        parent, node.parent = node.parent, None
        parent.children -= 1
        node = parent


def _precedes(a: _Node, b: _Node) -> bool:
    """The edits that end in ``a`` come before those that end in ``b``, from where they part."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Search:
    """Survivors over the rows of a stretch, from one state at its beginning."""

    def __init__(self, entry: int, costs: Costs):
        self.costs = costs
        # What can be reached from a state can be reached from another one at no more than
        # this besides: by insertions, and by deleting a system row that cannot be kept.
        self.besides = {}
        for x in range(STATES):
            for y in range(STATES):
                steps, state = 0, y
                while x != state and not (state in ACCEPTED and x != USER):
                    steps, state = steps + 1, NEXT[state]
                lost = costs.delete if x == START and y != START else 0
                self.besides[x, y] = steps * costs.insert + lost
        self.root = _Node("", None, entry, None)
        self.root.children = 1
        self.best: list[tuple[int, _Node] | None] = [None] * STATES
        self.best[entry] = (0, self.root)

    def _offer(self, best, cost, edit, at, state, parent) -> bool:
        held = best[state]
        if held is not None and held[0] < cost:
            return False
        node = _Node(edit, at, state, parent)
        if held is not None and held[0] == cost and not _precedes(node, held[1]):
            _release(node)
            return False
        node.children += 1
        best[state] = (cost, node)
        if held is not None:
            held[1].children -= 1
            _release(held[1])
        return True

    def insertions(self) -> None:
        """Let empty rows be inserted before the next row or at the end."""
        again = True
        while again:
            again = False
            for state in range(STATES):
                if self.best[state] is not None:
                    cost, node = self.best[state]
                    to = NEXT[state]
                    again |= self._offer(self.best, cost + self.costs.insert, "I", None, to, node)

    def row(self, initial: str, fault: int, at) -> None:
        self.insertions()
        new: list[tuple[int, _Node] | None] = [None] * STATES
        extra = self.costs.truncated if fault == TRUNCATED else 0
        for state, held in enumerate(self.best):
            if held is None:
                continue
            cost, node = held
            self._offer(new, cost + self.costs.delete, "D", at, state, node)
            if fault in (BLANK, DUPLICATE):
                continue
            if (initial, state) in KEEP:
                self._offer(new, cost + extra, "K", at, KEEP[initial, state], node)
            self._offer(new, cost + self.costs.rerole + extra, "R", at, NEXT[state], node)
        for held in self.best:
            if held is not None:
                held[1].children -= 1
                _release(held[1])
        self.best = new
        self._drop_hopeless()

    def _drop_hopeless(self) -> None:
        """Give up survivors that another one beats whatever follows; without this the
        one that deleted every row so far would keep all others from being settled."""
        costs = [None if held is None else held[0] for held in self.best]
        for x, held in enumerate(self.best):
            if held is not None and any(
                    c is not None and held[0] > c + self.besides[x, y] for y, c in enumerate(costs)):
                self.best[x] = None
                held[1].children -= 1
                _release(held[1])

    def settled(self) -> Iterator[_Node]:
        """The edits that all survivors share, which then leave the tree.

        The root refers to one child only if no survivor and no other branch needs it.
        """
        ends = {id(held[1]) for held in self.best if held is not None}
        path = []
        node = min((held[1] for held in self.best if held is not None), key=lambda n: n.depth)
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            if id(self.root) in ends or self.root.children > 1:
                return
            self.root.parent = None
            self.root = node
            yield node
            node.parent = None

    def end(self, state: int) -> list[_Node]:
        """The edits up to a survivor that are not settled yet."""
        node, path = self.best[state][1], []
        while node is not self.root:
            path.append(node)
            node = node.parent
        return path[::-1]

    def finish(self) -> int:
        """Allow insertions at the end, and give the accepted state that wins."""
        self.insertions()
        held = [(s, *self.best[s]) for s in ACCEPTED if self.best[s] is not None]
        state, cost, node = held[0]
        for other, c, n in held[1:]:
            if c < cost or (c == cost and _precedes(n, node)):
                state, cost, node = other, c, n
        return state

    def summary(self) -> list[int]:
        """For each state its cost and its rank by the edits; -1 where there is none."""
        order: list[int] = []
        for state in range(STATES):
            if self.best[state] is not None:
                place = 0
                while place < len(order) and _precedes(self.best[order[place]][1], self.best[state][1]):
                    place += 1
                order.insert(place, state)
        return [x for s in range(STATES) for x in (
            (self.best[s][0], order.index(s)) if self.best[s] is not None else (-1, -1))]


def _chain(parts: list[list[int]], costs: Costs) -> list[tuple[int, int]]:
    """The (entry, exit) states of the stretches of one conversation, in order.

    ``parts`` holds for each stretch the summaries from all four entry states. The exit
    of the last stretch is the state before insertions at the end.
    """
    def cell(part, entry, leave):
        return part[2 * (STATES * entry + leave)], part[2 * (STATES * entry + leave) + 1]

    # What it costs to go on from a state, and by which edits; at the end, insertions.
    ahead = []
    for state in range(STATES):
        closing, cost, edits = state, 0, ""
        while closing not in ACCEPTED:
            closing, cost, edits = NEXT[closing], cost + costs.insert, edits + "I"
        ahead.append(cost)
    tails = [ahead]
    for part in reversed(parts):
        tails.append([min((cell(part, e, x)[0] + tails[-1][x] for x in range(STATES) if cell(part, e, x)[0] >= 0),
                          default=1 << 60) for e in range(STATES)])
    tails.reverse()
    out, entry = [], START
    for part, here, after in zip(parts, tails, tails[1:]):
        leave = min((x for x in range(STATES) if cell(part, entry, x)[0] >= 0
                     and cell(part, entry, x)[0] + after[x] == here[entry]), key=lambda x: cell(part, entry, x)[1])
        out.append((entry, leave))
        entry = leave
    return out


def fault_of(text: Column, repeated: Column) -> Column:
    """The first fault of a row: blank, duplicate, truncated, or 0."""
    last = F.regexp_extract(text, "([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z", 1)
    return F.when(last == "", BLANK).when(repeated, DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0)


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in order, equal ones as one with their number ``times``, and their fault.

    A row repeats an earlier one unless it has the least turn of its role and text, which
    is joined by that turn too, so that a text that fills a conversation stays spread.
    """
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times"))
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    least = counted.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min(place).alias("place"))
    known = counted.withColumn("digest", F.sha2("text", 256)).withColumn("place", place)
    names = ["conv_id", "role", "digest", "place"]
    a, b = known.alias("a"), least.withColumn("first", F.lit(True)).alias("b")
    on = None
    for name in names:
        same = F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
        on = same if on is None else on & same
    fault = fault_of(F.col("text"), F.col("first").isNull())
    found = a.join(b, on, "left").select(
        "a.conv_id", "a.turn", "a.role", "a.text", "a.times", fault.alias("fault"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order)


def _numbered(ordered: DataFrame) -> DataFrame:
    """Write the rows with their task ``part`` and place ``at``, and deal them out by task.

    Both passes read what was written, so a lost task finds the same stretches again.
    """
    kinds = ordered.schema.simpleString()[len("struct<"):-1]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())],
                [*batch.schema.names, "part", "at"])
            at += n

    return materialize(ordered.mapInArrow(number, f"{kinds}, part int, at long"), "conversations")


def _dealt(numbered: DataFrame, columns: list[str]) -> DataFrame:
    parts = max(1, (numbered.agg(F.max("part")).first()[0] or 0) + 1)
    return numbered.select(*columns).repartition(parts, "part").sortWithinPartitions("part", "at")


def _stretches(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """(key, first of its part, rows) in order; the rows must be read before going on."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))

    part = None
    for key, group in itertools.groupby(rows(), key=lambda r: r[:2]):
        yield key, key[0] != part, group
        part = key[0]


@dataclass(frozen=True)
class Repair:
    """``edits``: part, at, step (order of the edits), conv_id, edit, role, text of the repaired row.
    ``report``: a row for each conversation. ``split``: conversations that several tasks hold."""

    edits: DataFrame
    report: DataFrame
    split: list


def repair(rows: DataFrame, costs: Costs = Costs()) -> Repair:
    """Repair conversations (conv_id, turn, role, text).

    Rows are taken by turn, nulls first, then by role and text; null roles and texts are
    one space. A row's first fault counts: blank, a repetition of an earlier role and
    text, or truncated (its last visible character is none of ``.!?``). Blank and repeated
    rows must be deleted, truncated ones that stay cost more. Only roles that begin with
    s, u or a can be kept, an empty one cannot. A null conv_id is a conversation. Other columns are not read; an empty table gives no conversation.

    ``report`` has blank, duplicate, truncated, illegal (neighbours whose role initials are
    not su, ua or au) and cost. ``edits`` has a row for each edit, with the repaired role
    and text, null for a deletion, ordered by part, at and step.
    """
    spark = rows.sparkSession
    space = F.lit(" ")
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = rows.schema["conv_id"].dataType.simpleString()
    numbered = _numbered(_ordered(rows))
    slim = _dealt(numbered.withColumn("initial", F.substring("role", 1, 1)),
                  ["part", "conv_id", "at", "initial", "fault", "times"])
    names = ["part", "conv_id", "at", "initial", "fault", "times"]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {n: [] for n in ("part", "conv_id", "first", "last", "begins", "ends", "illegal", "summary")}

        def flush():
            table = pa.RecordBatch.from_arrays([
                pa.array(out["part"], pa.int32()), pa.array(out["conv_id"], key_type), pa.array(out["first"], pa.bool_()),
                pa.array(out["last"], pa.bool_()), pa.array(out["begins"], pa.string()), pa.array(out["ends"], pa.string()),
                pa.array(out["illegal"], pa.int64()), pa.array(out["summary"], pa.list_(pa.int64()))], list(out))
            for values in out.values():
                values.clear()
            return table

        pending = None
        for (part, conv), first, group in _stretches(batches, names):
            if pending is not None:
                pending["last"] = pending["part"] != part
                for n, v in pending.items():
                    out[n].append(v)
                if len(out["part"]) >= 4096:
                    yield flush()
            searches = [Search(e, costs) for e in (range(STATES) if first else (START,))]
            begins = ends = None
            illegal = seen = 0
            for _, _, at, initial, fault, times in group:
                for _ in range(times):
                    illegal += ends is not None and ends + initial not in ("su", "ua", "au")
                    begins, ends = initial if begins is None else begins, initial
                    seen += 1
                    for search in searches:
                        search.row(initial, fault, None)
                        if seen % SETTLE_ROWS == 0:
                            for _ in search.settled():
                                pass
                    fault = fault if fault == BLANK else DUPLICATE
            summaries = [x for s in searches for x in s.summary()]
            if not first:
                summaries += [-1] * (2 * STATES * (STATES - 1))
            pending = {"part": part, "conv_id": conv, "first": first, "last": False, "begins": begins, "ends": ends,
                       "illegal": illegal, "summary": summaries}
        if pending is not None:
            pending["last"] = True
            for n, v in pending.items():
                out[n].append(v)
            yield flush()

    key_type = to_arrow_type(rows.schema["conv_id"].dataType)
    found = materialize(slim.mapInArrow(
        first_pass, f"part int, conv_id {key}, first boolean, last boolean, begins string, ends string,"
                    " illegal long, summary array<long>"), "stretches")
    # At most two stretches of each task can go on in another one.
    seams: dict = {}
    for row in found.where("first or last").orderBy("part", F.desc("first")).collect():
        seams.setdefault(row["conv_id"], []).append(row)
    seams = {conv: parts for conv, parts in seams.items() if len(parts) > 1}
    plan = {}
    joints = [(conv, sum(a["ends"] + b["begins"] not in ("su", "ua", "au") for a, b in zip(parts, parts[1:])))
              for conv, parts in seams.items()]
    for conv, parts in seams.items():
        states = _chain([list(p["summary"]) for p in parts], costs)
        for i, (p, (entry, leave)) in enumerate(zip(parts, states)):
            plan[p["part"], conv] = (entry, leave, i == len(parts) - 1)
    plan = spark.sparkContext.broadcast(plan)
    fields = ["part", "conv_id", "at", "initial", "fault", "times", "role", "text"]

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush():
            kinds = [pa.int32(), pa.int64(), pa.int64(), key_type, pa.string(), pa.string(), pa.string(), pa.int64()]
            table = pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)],
                ["part", "at", "step", "conv_id", "edit", "role", "text", "cost"])
            out.clear()
            return table

        for (part, conv), _, group in _stretches(batches, fields):
            entry, leave, closes = plan.value.get((part, conv), (START, None, True))
            search, step, last, seen = Search(entry, costs), 0, None, 0

            def emit(node):
                nonlocal step, last
                if node.edit == "I":
                    row = (part, last, step, conv, "I", ROLES[node.state], "", costs.insert)
                else:
                    at, role, text, fault = node.at
                    last = at
                    extra = costs.truncated if fault == TRUNCATED else 0
                    if node.edit == "D":
                        row = (part, at, step, conv, "D", None, None, costs.delete)
                    elif node.edit == "K":
                        row = (part, at, step, conv, "K", role, text, extra)
                    else:
                        row = (part, at, step, conv, "R", ROLES[node.state], text, costs.rerole + extra)
                out.append(row)
                step += 1

            for _, _, at, initial, fault, times, role, text in group:
                last = at if last is None else last
                for _ in range(times):
                    search.row(initial, fault, (at, role, text, fault))
                    fault = fault if fault == BLANK else DUPLICATE
                    seen += 1
                    if seen % SETTLE_ROWS == 0:
                        for node in search.settled():
                            emit(node)
                            if len(out) >= 1024:
                                yield flush()
            if closes and leave is None:
                leave = search.finish()
            elif closes:
                search.insertions()
                while leave not in ACCEPTED:
                    leave = NEXT[leave]
            for node in search.end(leave):
                emit(node)
            if len(out) >= 1024:
                yield flush()
        if out:
            yield flush()

    edits = materialize(_dealt(numbered.withColumn("initial", F.substring("role", 1, 1)), fields).mapInArrow(
        second_pass, f"part int, at long, step long, conv_id {key}, edit string, role string, text string, cost long"),
        "edits")
    times, fault = F.col("times"), F.col("fault")
    n = F.lit(0).cast("long")
    counts = numbered.select(
        "conv_id", F.when(fault == BLANK, times).otherwise(n).alias("blank"),
        F.when(fault == BLANK, n).when(fault == DUPLICATE, times).otherwise(times - 1).alias("duplicate"),
        F.when(fault == TRUNCATED, n + 1).otherwise(n).alias("truncated"), n.alias("illegal"), n.alias("cost"))
    zero = [n.alias(c) for c in ("blank", "duplicate", "truncated")]
    neighbours = found.select("conv_id", *zero, "illegal", n.alias("cost"))
    if joints:
        neighbours = neighbours.unionByName(spark.createDataFrame(
            joints, f"conv_id {key}, illegal long").select("conv_id", *zero, "illegal", n.alias("cost")))
    costed = edits.select("conv_id", *zero, n.alias("illegal"), "cost")
    report = counts.unionByName(neighbours).unionByName(costed).groupBy("conv_id").agg(
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")))
    return Repair(edits, report, list(seams))


def digests(repaired: Repair) -> DataFrame:
    """(conv_id, audit, repaired_sha256): the initials of the edits, and the hash of the
    repaired rows as ``role:text`` lines.

    Hashing goes over the rows in order as a stream. Conversations within one task are
    hashed where they are; the others meet in one task each, because a hash of a whole
    cannot be put together from hashes of its parts.
    """
    edits = repaired.edits
    kind = edits.schema["conv_id"].dataType
    key_type = to_arrow_type(kind)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist()
                                 for n in ("conv_id", "edit", "role", "text")))

        out: list[tuple] = []
        for conv, group in itertools.groupby(rows(), key=lambda r: r[0]):
            audit, digest, begun = bytearray(), hashlib.sha256(), False
            for _, edit, role, text in group:
                audit += edit.encode()
                if edit != "D":
                    digest.update((b"\n" if begun else b"") + f"{role}:{text}".encode())
                    begun = True
            out.append((conv, audit.decode(), digest.hexdigest()))
            if len(out) >= 4096:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(zip(*out), (key_type, pa.string(), pa.string()))],
            ["conv_id", "audit", "repaired_sha256"])

    schema = f"conv_id {kind.simpleString()}, audit string, repaired_sha256 string"
    spark = edits.sparkSession
    split = F.lit(False)
    if repaired.split:
        # At most one conversation for each seam between two tasks.
        marks = spark.createDataFrame([(c, True) for c in repaired.split],
                                      f"conv_id {kind.simpleString()}, split boolean")
        edits = edits.alias("e").join(F.broadcast(marks.alias("m")), F.col("e.conv_id").eqNullSafe(F.col("m.conv_id")),
                                      "left").select("e.*", "m.split")
        split = F.coalesce("split", F.lit(False))
    parts = max(1, (edits.agg(F.max("part")).first()[0] or 0) + 1)
    order = ["part", "at", "step"]
    near = edits.where(~split).select("conv_id", "edit", "role", "text", *order).repartition(
        parts, "part").sortWithinPartitions("part", "at", "step")
    if not repaired.split:
        return near.mapInArrow(hashed, schema)
    far = edits.where(split).select("conv_id", "edit", "role", "text", *order).repartition(
        parts, "conv_id").sortWithinPartitions("conv_id", *order)
    return near.mapInArrow(hashed, schema).unionByName(far.mapInArrow(hashed, schema))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of conversation and turn; nulls are one space.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 removes ``.!?``, 3 repeats
    it and 4 makes it a user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("case")).where("case <> 0")
    role = F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(F.col("case") == 1, F.lit("")).when(
        F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop(
        "copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """What the repair of damaged conversations comes to, a row for each original conv_id.

    gaps counts the turns missing between the least and the greatest, nulls aside. A
    conversation that lost all rows has zeros, no edits and the hash of nothing. Repeated
    rows and rows with the same turn are all taken; an empty table gives no row.
    """
    rows = materialize(damage(conversations), "damaged")
    repaired = repair(rows)
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn")).distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    found = conversations.select("conv_id").distinct()
    for side in (turns, repaired.report, digests(repaired)):
        a, b = found.alias("a"), side.alias("b")
        found = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")), "left").select(
            "a.*", *(f"b.{c}" for c in side.columns if c != "conv_id"))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
