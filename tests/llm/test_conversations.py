import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        out += [(c, t, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        visible = re.findall("[^\\x20\\x09-\\x0D]", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else (
            "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, costs):
    """All edits of all rows, kept as (cost, audit, repaired rows) for every end of the pattern."""
    def legal(roles):
        return re.fullmatch("(s?(ua)+)?", roles)

    def insertions(paths):
        for _ in range(3):
            paths = paths + [(c + costs.insert, a + "I", r + [(role, "")], i + role[0]) for c, a, r, i in paths
                             for role in ("user", "assistant")]
            paths = pruned(paths)
        return paths

    def pruned(paths):
        """Of the paths whose roles end alike, the best one: what follows is the same for them."""
        best = {}
        for path in paths:
            begun = re.fullmatch("(s?(ua)*u?)?", path[3])
            if begun:
                end = path[3][-1:]
                if end not in best or path[:2] < best[end][:2]:
                    best[end] = path
        return list(best.values())

    paths = [(0, "", [], "")]
    for (_, _, role, text), fault in zip(rows, faults(rows)):
        paths, after = insertions(paths), []
        for c, a, r, i in paths:
            after.append((c + costs.delete, a + "D", r, i))
            if fault not in ("blank", "duplicate"):
                c += costs.truncated if fault == "truncated" else 0
                after.append((c, a + "K", r + [(role, text)], i + (role[:1] or "-")))
                after += [(c + costs.rerole, a + "R", r + [(x, text)], i + x[0]) for x in ("user", "assistant")]
        paths = pruned([p for p in after if p[3] == "" or re.fullmatch("s?(ua)*u?", p[3])])
    return min((p for p in insertions(paths) if legal(p[3])), key=lambda p: p[:2])


def every_sequence(rows, costs):
    """The same by trying all sequences of edits with at most two insertions in a place."""
    marks, best = faults(rows), None
    gaps = ["", "I", "II"]
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(m in ("blank", "duplicate") and e != "D" for m, e in zip(marks, edits)):
            continue
        for where in itertools.product(gaps, repeat=len(rows) + 1):
            audit = where[0] + "".join(e + w for e, w in zip(edits, where[1:]))
            cost = sum({"D": costs.delete, "K": 0, "R": costs.rerole, "I": costs.insert}[e] for e in audit)
            cost += sum(costs.truncated for m, e in zip(marks, edits) if m == "truncated" and e != "D")
            if best is not None and (cost, audit) >= best:
                continue
            initials, at = [], 0
            for e in audit:
                if e in "RI":
                    initials.append("ua")
                elif e == "K":
                    initials.append(rows[at][2][:1])
                at += e != "I"
            if any(re.fullmatch("(s?(ua)+)?", "".join(p)) for p in itertools.product(*initials)):
                best = (cost, audit)
    return best


def expected(rows, costs=conv.Costs(), damage=True):
    out = {}
    held = damaged(rows) if damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in held if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = [r[1] for r in mine if r[1] is not None]
        marks = faults(mine)
        cost, audit, repaired, _ = cheapest(mine, costs)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"),
                  marks.count("duplicate"), marks.count("truncated"), illegal, cost, audit,
                  hashlib.sha256(text.encode()).hexdigest())
    return out


def found(df):
    names = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    rows = conv.damaged_and_repaired(df).collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


@pytest.fixture
def many_tasks(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def random_rows(draw, conv_id, n):
    roles, texts = ["system", "user", "assistant", "tool", "s", " "], ["a.", "b", "", "c!", " ", "d?\n", "e"]
    return [(conv_id, i, draw.choice(roles[:3] * 3 + roles), draw.choice(texts) + draw.choice(["", f"{i}.", f"{i}"]))
            for i in range(n)]


def test_whole_table(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found(table) == expected([tuple(r) for r in table.collect()])


@pytest.mark.parametrize("costs", [conv.Costs(), conv.Costs(2, 3, 1, 1), conv.Costs(1, 1, 1, 0), conv.Costs(3, 2, 1, 5)])
def test_search_against_every_sequence(costs):
    draw = random.Random(11)
    for n in [0, 1, 2, 3, 3, 4, 4, 4]:
        rows = random_rows(draw, 1, n)
        search = conv.Search(conv.START, costs)
        emitted = []
        for row, fault in zip(rows, faults(rows)):
            search.row(row[2][:1], ["", "blank", "duplicate", "truncated"].index(fault), row)
            emitted += [node.edit for node in search.settled()]
        state = search.finish()
        audit = "".join(emitted + [node.edit for node in search.end(state)])
        assert (search.best[state][0], audit) == every_sequence(rows, costs)
        assert (search.best[state][0], audit) == cheapest(rows, costs)[:2]


def test_memory_is_bounded_by_what_is_not_settled():
    import gc
    search = conv.Search(conv.START, conv.Costs())
    draw = random.Random(2)
    for row in random_rows(draw, 1, 20_000):
        search.row(row[2][:1], draw.choice([0, 0, 0, 1, 3]), None)
        for _ in search.settled():
            pass
    gc.collect()
    assert sum(isinstance(o, conv._Node) for o in gc.get_objects()) < 500


def test_long_conversations_over_many_tasks(spark, many_tasks):
    draw = random.Random(4)
    rows = random_rows(draw, 7, 700) + random_rows(draw, 8, 300) + [
        r for c in range(20, 60) for r in random_rows(draw, c, draw.randint(1, 6))]
    rows += [(9, t, role, f"text {t}.") for t in range(300) for role in (["user"] if t % 2 == 0 else ["assistant"])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    repaired = conv.repair(df)
    assert set(repaired.split) >= {7}
    assert found(df) == expected(rows)


@pytest.mark.parametrize("costs", [conv.Costs(2, 3, 1, 1), conv.Costs(1, 2, 1, 0)])
def test_insertions_at_the_seams(spark, many_tasks, costs):
    draw = random.Random(9)
    rows = random_rows(draw, 1, 400) + random_rows(draw, 2, 90)
    df = spark.createDataFrame(rows, SCHEMA)
    repaired = conv.repair(df, costs)
    assert 1 in repaired.split
    want = expected(rows, costs, damage=False)
    audits = {r["conv_id"]: (r["audit"], r["repaired_sha256"]) for r in conv.digests(repaired).collect()}
    assert audits == {c: w[6:] for c, w in want.items()}
    report = {r["conv_id"]: (r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"])
              for r in repaired.report.collect()}
    assert report == {c: w[1:6] for c, w in want.items()}


def test_nulls_ties_repeats_and_clashing_names(spark, clashing):
    rows = [(1, None, "user", "a."), (1, 0, None, "b."), (1, 0, None, "b."), (1, 3, "assistant", None), (1, None, None, None),
            (None, 1, "system", "s."), (None, 2, "user", "u."), (None, 3, "assistant", "x."), (None, None, "user", "."),
            (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 5, "assistant", "same."), (2, 5, "", "no role."),
            (3, -4, "unter", "kept as u."), (3, 9, "a", "kept as a!"), (4, 0, "tool", ""), (5, 1, "user", "漢字 。"),
            (6, 1, "user", "long " * 50_000 + "."), (6, 2, "assistant", "x" * 100_000)]
    df = clashing(spark.createDataFrame(rows, SCHEMA)).withColumns(
        {c: F.lit(3) for c in ("part", "at", "step", "edit", "times", "fault", "digest", "first")})
    assert found(df) == expected(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == {}


def test_a_row_repeated_many_times_is_one_row_with_a_number(spark):
    rows = [(1, 0, "user", "q."), (1, 1, "assistant", "r.")] + [(1, 1, "assistant", "r.")] * 3000 + [
        (2, t, "user", "always the same.") for t in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert conv._ordered(df).count() == 2 + 2000
    assert found(df) == expected(rows)
