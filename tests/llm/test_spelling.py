import random
import re
import zlib
from collections import Counter, defaultdict

from tallyloom.llm import spelling


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(counts):
    """By the texts that are left when one character is deleted, or none."""
    meet, close = defaultdict(set), defaultdict(set)
    for w in counts:
        for v in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            meet[v].add(w)
    for group in meet.values():
        for a in group:
            close[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(close[w], key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w] or "", root(w), n, len(close[w]), counts.get(form[w], -1)) for w, n in counts.items())


def as_rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r[0], r[1] or "", r[2], r[3], r[4], -1 if r[5] is None else r[5]) for r in df.collect())


def test_whole_texts(documents):
    rows = documents.select("doc_id", "text").collect()
    assert as_rows(spelling.spelling_variants(documents)) == expected(words_of(rows))


def test_messy_rows(messy, empty, clashing):
    rows = messy.select("doc_id", "text").collect()
    assert as_rows(spelling.spelling_variants(clashing(messy))) == expected(words_of(rows))
    assert spelling.spelling_variants(empty).count() == 0


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_dense_neighbourhoods_with_a_small_dictionary(spark, monkeypatch):
    """Few letters, so that nearly all words are near others and grams are frequent."""
    draw = random.Random(6)
    for frequent, size in ((1, 1 << 19), (8, 1 << 19), (64, 40), (10**9, 10)):
        monkeypatch.setattr(spelling.frequent_grams, "__defaults__", (frequent, size))
        counts = {"".join(draw.choice("abé") for _ in range(draw.randint(5, 9))): draw.randint(3, 400) for _ in range(900)}
        counts |= {c * n: draw.randint(3, 50) for c in "aé" for n in range(5, 40)}
        assert as_rows(spelling.variants(table(spark, counts))) == expected(counts)


def test_ties_chains_and_long_words(spark):
    long = "abcdefghij" * 500
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "xxaaaaa": 500,
              "zzzzz": 5, "zzzzy": 10, "zzzzw": 10, long: 4, long[:2500] + long[2501:]: 9, long + "q": 9}
    assert as_rows(spelling.variants(table(spark, counts))) == expected(counts)


def test_an_edit_spares_the_grams_that_it_does_not_lie_under():
    draw = random.Random(8)
    frequent = {"".join(draw.choice("ab^$") for _ in range(n)): 1 for n in (2, 3, 4, 5) for _ in range(6 * n)}
    for _ in range(2000):
        word = "".join(draw.choice("ab") for _ in range(draw.randint(5, 12)))
        at, kind = draw.randrange(len(word)), draw.choice("idr")
        other = word[:at] + {"i": "b" + word[at], "d": "", "r": "c"}[kind] + word[at + 1:]
        shift = len(other) - len(word)
        grams, affected = spelling.decompose(word, frequent)
        others = set(spelling.decompose(other, frequent)[0])
        spared = [g for g in grams if g in others or (g[0] + shift, g[1]) in others]
        assert len(spared) >= len(grams) - affected
        assert affected < len(grams)
