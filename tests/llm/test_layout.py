"""Sharding, archive and mixing."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import mixing, sharding, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class LocalEnds(sharding.GroupEnds):
    """The search with group ends that are in memory."""

    def __init__(self, ends, step_ends):
        self.all = np.array(ends)
        super().__init__(None, ends[-1], step_ends)

    def _refine(self, gaps):
        assert gaps
        known = {int(e): bool(h) for e, h in zip(self.ends, self.hidden)}
        for j in gaps:
            low, high = int(self.ends[j - 1]) if j else 0, int(self.ends[j])
            width = max(1, (high - low) // self.step_ends)
            known[high] = False
            cells = defaultdict(list)
            for e in self.all[(self.all > low) & (self.all <= high)].tolist():
                cells[(e - low - 1) // width].append(e)
            for cell in cells.values():
                known[max(cell)] = len(cell) > 2
                known[min(cell)] = False
        self.ends = np.array(sorted(known))
        self.hidden = np.array([known[int(e)] for e in self.ends])


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, need, load = (low + high) // 2, 1, 0
        for s in sizes:
            if load + s > middle:
                need, load = need + 1, 0
            load += s
        low, high = (low, middle) if need <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("seed", range(12))
def test_capacity_is_the_smallest(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 8, 9, 50, 1000, 30_000][: rng.randint(1, 6)]) for _ in range(rng.randint(1, 400))]
    ends = np.cumsum(sizes).tolist()
    for shards in (1, 2, 5, 24):
        search = LocalEnds(ends, step_ends=rng.choice([2, 7, 64]))
        least = least_capacity(sizes, shards)
        assert search.capacity(shards) == least
        cuts = search.cuts(shards)
        assert len(cuts) == shards and cuts[-1] == ends[-1] and set(cuts) <= {0, *ends}
        assert max(np.diff([0, *cuts])) <= least and min(np.diff([0, *cuts])) >= 0


def check_shards(source, got, shards):
    expected = sorted(((i, len((t or "").encode()) + 8,
                        None if t is None else zlib.crc32(t.encode())) for i, t in source), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == expected
    slots, groups = defaultdict(list), {}
    for r in got:
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        assert groups.setdefault((r["size"], r.text_crc32), r.shard) == r.shard
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding(messy, clashing, empty, documents):
    for df, n in ((messy, 4), (clashing(messy), 4), (documents, 24), (messy, 1)):
        got = sharding.shard(df, n, step_ends=16).collect()
        check_shards([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], got, n)
    assert sharding.shard(empty).count() == 0
    sizes = defaultdict(int)
    for r in sharding.shard(documents, 8).collect():
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) < 1.1 * min(sizes.values())


def test_archive(spark, clashing):
    big, small = "<html>" + "é" * 60, "short"
    rows = [(5, "http://a", big), (3, "http://b\r\nX: y", big), (3, None, big), (9, "u", None),
            (8, "u", ""), (1, "u", small), (2, "u", small), (None, "n", big), (None, "m", "only null" * 20),
            (None, "m", "only null" * 20), (7, "u", "A\r\n\r\nB" * 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for df in (pages, clashing(pages)):
        got = warc.read_archive(spark, warc.write_archive(df)).collect()
        expected = []
        for key, _, html in rows:
            data = (html or "").encode()
            revisit = html == big and key != 3
            expected.append((key, len(data), hashlib.sha256(data).hexdigest(),
                             "revisit" if revisit else "response", 3 if revisit else None))
        assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type",
                                            "refers_to")) for r in got), key=repr) == sorted(expected, key=repr)
        for r in got:
            record, payload = bytes(r.record), bytes(r.payload)
            assert hashlib.sha256(payload).hexdigest() == r.payload_digest
            assert bytes(r.original).split(b"\r\n\r\n", 1)[1] == payload
            head, block = record[:-4].split(b"\r\n\r\n", 1)
            assert int(re.search(rb"Content-Length: (\d+)", head)[1]) == len(block)
    folder = warc.write_archive(pages)
    stored = spark.read.parquet(f"{folder}/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({r[2] or "" for r in rows})
    assert warc.read_archive(spark, warc.write_archive(pages.limit(0))).count() == 0


@pytest.mark.parametrize("damage", ["missing", "replaced"])
def test_damaged_archive_is_refused_whatever_is_read(spark, tmp_path, damage):
    pages = spark.createDataFrame([(1, "u", "x" * 200), (2, "u", "y")], "page_id long, url string, html string")
    folder = warc.write_archive(pages, str(tmp_path / "archive"))
    payloads = spark.read.parquet(f"{folder}/payloads")
    if damage == "missing":
        payloads.limit(1).write.parquet(f"{tmp_path}/other")
    else:
        payloads.withColumn("payload", F.lit(b"other")).write.parquet(f"{tmp_path}/other")
    (tmp_path / "archive" / "payloads").rename(tmp_path / "whole")
    (tmp_path / "other").rename(tmp_path / "archive" / "payloads")
    found = warc.read_archive(spark, folder)
    for column in found.columns:
        with pytest.raises(Exception, match="no sound payload"):
            found.select(column).collect()
    with pytest.raises(Exception, match="no sound payload"):
        found.count()


def shared_targets(sizes, weights, passes=3):
    """Targets by hand: share by weight, cap, share the excess again."""
    targets, open_, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        weight = sum(weights[i] for i in open_)
        share = {i: rest * weights[i] / weight for i in open_}
        above = {i for i in open_ if share[i] > passes * sizes[i]}
        for i in above or open_:
            targets[i] = float(passes * sizes[i]) if above else share[i]
        rest -= sum(targets[i] for i in above)
        open_ = open_ - above if above else set()
    return targets


def test_targets(spark):
    def targets(sizes, weights):
        rows = spark.createDataFrame(list(enumerate(zip(sizes, map(float, weights)))),
                                     "i int, x struct<size:long,weight:double>").select("i", "x.*")
        return [r.target for r in mixing.source_targets(rows).orderBy("i").collect()]

    assert targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    assert targets([1, 1, 100], [1, 2, 3]) == [3.0, 3.0, 96.0]
    assert targets([0, 0], [1, 2]) == [0.0, 0.0] and targets([], []) == []
    random.seed(3)
    sizes = [int(2 ** random.uniform(0, 30)) for _ in range(300)]
    weights = [1 + i % 3 for i in range(300)]
    assert targets(sizes, weights) == shared_targets(sizes, weights)


def reversed_bits(i, bits):
    return int(f"{i:0{bits}b}"[::-1], 2)


def slots_by_points(plan, block):
    """The schedule from its points, one after the other."""
    ends, at = [], 0
    for s, size, take in plan:
        blocks = -(-size // block)
        at += (take // size) * blocks + -(-(take % size) // block) if size else 0
        ends.append((at, s, size, take, blocks))
    bits, rank, out = max(1, (at - 1).bit_length()), defaultdict(int), []
    for i in range(1 << bits):
        place = reversed_bits(i, bits)
        if place < at:
            _, s, size, take, blocks = next(e for e in ends if place < e[0])
            p, b = divmod(rank[s], blocks)
            rank[s] += 1
            out.append((len(out), s, p, b, min(block, size - b * block, take - p * size - b * block)))
    return out


@pytest.mark.parametrize("block", [1, 7, 512])
def test_mixing(spark, messy, clashing, documents, empty, block):
    for df in (messy, clashing(messy), documents):
        source = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in
                  df.select("doc_id", "source", "text").collect()]
        if df is documents and block == 1:
            continue
        got = mixing.mix(df, block_words=block).collect()
        assert sorted(((r.doc_id, r.source, r["size"]) for r in got), key=repr) == sorted(source, key=repr)
        names = sorted({s for _, s, _ in source}, key=lambda s: (s is None, s))
        total = {n: sum(z for _, s, z in source if s == n) for n in names}
        targets = dict(zip(names, shared_targets(
            [total[n] for n in names], [1 + i % 3 for i in range(len(names))])))
        taken = defaultdict(int)
        for r in got:
            taken[r.source] += r.taken
            assert r.source_size == total[r.source] and r.target == targets[r.source]
            assert 0 <= r.taken <= 3 * r["size"] and (r.first_slot is None) == (r.taken == 0)
        assert all(abs(taken[n] - targets[n]) <= 0.5 for n in names)
        if df is documents:
            by_slot = {(s, p, b): slot for slot, s, p, b, _ in slots_by_points(
                [(n, total[n], int(targets[n] + 0.5)) for n in names], block)}
            for n in names:
                start = 0
                for r in sorted((r for r in got if r.source == n),
                                key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest()):
                    assert r.taken == 0 or r.first_slot == by_slot[n, 0, start // block]
                    start += r["size"]
        assert sorted(map(tuple, got), key=repr) == sorted(
            map(tuple, mixing.mix(df.repartition(3), block_words=block).collect()), key=repr)
    assert mixing.mix(empty).count() == 0


PLAN = "source long, size long, take long"


@pytest.mark.parametrize("plan, block", [
    ([(0, 1000, 1000), (1, 1000, 2000), (2, 500, 250), (3, 0, 0)], 10),
    ([(0, 1, 1)], 512), ([(0, 5, 15), (1, 70_000, 69_990)], 1), ([(0, 9, 0), (2, 9, 9), (5000, 30, 31)], 4)])
def test_schedule_is_that_of_the_points(spark, plan, block):
    got = mixing.schedule(spark.createDataFrame(plan, PLAN), block).orderBy("slot").collect()
    assert [tuple(r) for r in got] == slots_by_points(plan, block)


def test_schedule_interleaves(spark):
    slots = mixing.schedule(spark.createDataFrame(
        [(0, 1000, 1000), (1, 1000, 2000), (2, 500, 250), (3, 0, 0)], PLAN), 10).orderBy("slot").collect()
    assert [r.slot for r in slots] == list(range(325))
    assert sum(r.words for r in slots if r.source == 1) == 2000
    seen = [r.source for r in slots]
    for n in range(1, 326):
        for s, share in ((0, 100), (1, 200), (2, 25)):
            assert abs(seen[:n].count(s) - n * share / 325) < 5
    per_pass = defaultdict(list)
    for r in slots:
        per_pass[r.source, r["pass"]].append(r.block)
    assert all(b == list(range(len(b))) for b in per_pass.values())


def test_mixing_of_many_sources_and_of_one_id(spark):
    rows = spark.range(260_000).select(
        F.when(F.col("id") < 60_000, F.lit(1)).otherwise(F.col("id")).alias("doc_id"),
        F.expr("repeat('w ', 1 + CAST(id % 7 AS INT))").alias("text"),
        F.when(F.col("id") >= 60_000, F.col("id").cast("string")).alias("source"))
    got = mixing.mix(rows)
    by_source = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    facts = by_source.agg(F.count("*").alias("n"), F.max(F.abs(F.col("taken") - F.col("target"))).alias("off")).first()
    assert facts["n"] == 200_001 and facts["off"] <= 0.5
    assert got.where("taken > 3 * size OR taken < 0").count() == 0 and got.count() == 260_000
