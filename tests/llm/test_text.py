"""Token counts, repeats, SimHash, decontamination, language and toxicity against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from llm.conftest import rows_of
from pyspark.sql import functions as F

from tallyloom.llm import common, decontamination, language_id, repeats, simhash, token_counts, toxicity
from tallyloom.plans.storage import materialize

PATH = public_tokenizers.path("byte_bpe_50k.json")


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_token_counts(messy, clashing, empty, documents):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    for df in (messy, clashing(messy), documents):
        expected = []
        for i, t in texts_of(df):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            expected.append((i, len((t or "").encode()), n, n > 1024))
        assert rows_of(token_counts.token_counts(df, PATH)) == sorted(expected, key=repr)
    assert token_counts.token_counts(empty, PATH).count() == 0


def test_every_settled_character_splits_as_in_the_library():
    counter = token_counts.Counter_(PATH, {})
    texts = [f"a{chr(c)}{chr(c)} {chr(c)}1 b{chr(c)}\n" for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    settled = [t for t in texts if t.isascii() or token_counts.SETTLED.fullmatch(t)]
    assert len(settled) > 30_000
    assert [counter.count(t) for t in settled] == [
        len(e.ids) for e in counter.tokenizer.encode_batch(settled, add_special_tokens=False)]


def brute_repeats(rows):
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for p in range(len(data) - 49):
                s = data[p:p + 50]
                first[s] = min(i, first.get(s, i))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        if i is not None:
            for p in range(len(data) - 49):
                if first[data[p:p + 50]] < i:
                    gone[p:p + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_repeats(spark, messy, clashing, empty, documents):
    for df in (messy, clashing(messy), documents.where("doc_id < 120")):
        assert rows_of(repeats.remove_repeats(df)) == brute_repeats(texts_of(df))
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_random_pieces(spark, seed, monkeypatch):
    """Short alphabets, periodic texts, pieces of 49 to 51 bytes, several partitions."""
    rng = random.Random(seed)
    pool = ["".join(rng.choice("ab c"[: 2 + k % 3]) for _ in range(rng.choice([30, 49, 50, 51, 120])))
            for k in range(12)] + ["x" * 80, "ab" * 60, "é" * 40]
    rows = [(rng.randint(0, 40), "".join(rng.choice(pool) for _ in range(rng.randint(0, 5)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(repeats.remove_repeats(df)) == brute_repeats(rows)


def test_repeats_in_many_rows_of_one_id(spark):
    """Texts of one id are told apart however many they are, also where checksums agree."""
    rng = random.Random(7)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(20)]
    rows = [(4, passages[0] + passages[1]), (5, passages[0] + "own" * 40)]
    # Texts whose CRC-32 has the same last 20 bits, one with and one without an earlier passage.
    seen, twins = {}, []
    while len(twins) < 2:
        text = "".join(rng.choice("klmnopq") for _ in range(rng.choice([400, 130]))) + rng.choice(["", passages[1]])
        other = seen.setdefault(zlib.crc32(text.encode()) & 0xFFFFF, text)
        if len(other) != len(text):
            twins += [(5, other), (5, text)]
    rows += twins
    rows += [(5, f"{n} " * 12 + (passages[n % 20] if n % 3 else "") + f" {n}" * 12) for n in range(1500)]
    rows += [(6, passages[5]), (6, passages[5]), (6, passages[5] + "!"), (None, passages[0]), (6, None), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert rows_of(repeats.remove_repeats(df)) == brute_repeats(rows)


def test_repeats_of_a_long_periodic_text(spark):
    period = "".join(random.Random(3).choice("abcdefgh") for _ in range(61))
    long = period * 20_000
    found = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(
        [(1, period * 3), (2, long), (3, "q" * 60 + long)], "doc_id long, text string")).collect()}
    assert (found[1]["n_removed"], found[1]["n_spans"]) == (0, 0)
    assert (found[2]["n_removed"], found[2]["n_spans"]) == (len(long), 1)
    assert (found[3]["n_removed"], found[3]["n_spans"], found[3]["kept_sha256"]) == (
        len(long), 1, hashlib.sha256(b"q" * 60).hexdigest())


def test_parts_of_a_long_text(monkeypatch):
    import pyarrow as pa
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    batch = pa.RecordBatch.from_arrays([pa.array([3]), pa.array([0]), pa.array([text])], ["doc", "tag", "text"])

    def places():
        return {(g, c, p) for b in repeats._find_anchors(iter([batch]))
                for g, c, p in zip(*(b.column(i).to_pylist() for i in (0, 1, 3)))}

    whole = places()
    monkeypatch.setattr(repeats, "BUFFER_BYTES", 700)
    assert places() == whole and len(whole) > 300


def brute_print(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(messy, clashing, empty, documents):
    for df in (messy, clashing(messy), documents):
        rows = [(i, brute_print(t)) for i, t in texts_of(df)]
        group = list(range(len(rows)))
        for a in range(len(rows)):
            for b in range(a):
                if (rows[a][1] ^ rows[b][1]).bit_count() <= 4 and group[a] != group[b]:
                    group = [group[b] if g == group[a] else g for g in group]
        least = {}
        for (i, _), g in zip(rows, group):
            if i is not None:
                least[g] = min(i, least.get(g, i))
        expected = sorted(((i, f"{f:016x}", least.get(g)) for (i, f), g in zip(rows, group)), key=repr)
        assert rows_of(simhash.near_duplicates(df)) == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_every_pair_of_close_fingerprints_links_once(spark):
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        for bits in (0, 1, 2, 3, 4, 5, 5, 6):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_variants_of_fingerprints_are_not_broadcast(spark):
    """Spark takes all variants of a small table for no larger than the table."""
    prints = materialize(spark.range(3000).select(F.xxhash64("id").alias("fp")))
    plan = simhash.links(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201)] * 2
    names = {n: rng.randint(-(2**40), 2**40) for e in edges for n in e}
    rng.shuffle(edges)
    df = spark.createDataFrame([(names[a], names[b]) for a, b in edges], "a long, b long")
    got = {r.node: r.root for r in common.components(df).collect()}
    for group in (range(61), range(100, 160), (200, 201)):
        ids = [names[i] for i in group]
        assert all(got[i] == min(ids) for i in ids)
    assert common.components(df.limit(0)).count() == 0


def test_decontamination(spark, messy, clashing, empty, documents, small):
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    own = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (1, "quick, brown FOX jumps"), (2, "too short item"),
         (3, None), (None, "passage of more than fifty bytes that several"), (4, ""),
         (5, "quick brown fox jumps over the lazy dog"), (6, "a b c d e f g h i j"), (7, "LAZY"), (7, "lazy, dog."),
         (8, "the lazy dog near"), (9, "brown quick"), (10, "!?")],
        "item_id long, text string")
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    shingles = lambda w, n: {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    for docs, items in ((messy, own), (clashing(messy), clashing(own)), (documents, benchmark)):
        sought = [(r.item_id, split(r.text)) for r in items.select("item_id", "text").collect()]
        sought = [(i, min(5, len(w)), shingles(w, min(5, len(w)))) for i, w in sought if w]
        best = {}
        for i, t in texts_of(docs):
            has = {n: shingles(split(t), n) for n in range(1, 6)}
            for k, n, q in sought:
                if len(q & has[n]) / len(q) >= 0.8:
                    best[i, k] = max(best.get((i, k), 0), len(q & has[n]) / len(q))
        got = decontamination.contained_items(docs, items).collect()
        assert len(got) == len(best)
        assert {(r.doc_id, r.item_id): r.containment for r in got} == best and best
    assert decontamination.contained_items(empty, own).count() == 0
    assert decontamination.contained_items(messy, own.limit(0)).count() == 0


def test_short_items_are_found_as_a_whole(spark):
    docs = spark.createDataFrame([(1, "前 一段没有空格的文字 后"), (2, "say Hello, world!"), (3, "world hello")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "一段没有空格的文字"), (2, "hello world"), (3, "say hello world again")],
                                  "item_id long, text string")
    got = decontamination.contained_items(docs, items).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, 1, 1.0), (2, 2, 1, 1, 1.0)]


def brute_phrases(text, reference):
    """Phrases of a text, each the longest that the reference has, or one letter."""
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n + 1] in reference:
            n += 1
        count, at = count + 1, at + n
    return count


def test_cross_parsing():
    rng = random.Random(3)
    references = ["".join(rng.choice("abc d") for _ in range(300)), "".join(rng.choice("ade ") for _ in range(200))]
    coded = [np.array([ord(c) for c in r], np.uint32) for r in references]
    automata = language_id.Automata(["x", "y"], coded)
    texts = ["".join(rng.choice("abcdez ") for _ in range(n)) for n in (1, 5, 60, 400, 2048, 700, 2049, 5000, 20000)]
    # Periodic texts, whose pieces never come to end as if a phrase began with them.
    texts += [(references[0][:7] + "z" * 3) * 900, references[1][:31] * 300, "z" * 9000, references[0] * 20]
    got = automata.phrases([np.array([ord(c) for c in t], np.uint32) for t in texts])
    assert got.tolist() == [[brute_phrases(t, r) for r in references] for t in texts]


def test_learning_takes_different_texts_from_any_place(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(400)]
    long = "x " * 300_000 + " ".join(rng.choice(words) for _ in range(60_000))
    rows = [(i, "qqqq rrrr " * 30, "one") for i in range(400)] + [(9000 + i, f"{w} end", "one") for i, w in
                                                               enumerate(words[:40])]
    rows += [(20_000 + i, f"{i} " + long, "two") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(df)
    asked = spark.createDataFrame(
        [(i, " ".join(words[i:i + 12]), None) for i in range(40)], df.schema)
    taught = [w for i, w in enumerate(words[:40]) if zlib.crc32(str(9000 + i).encode()) % 3 != 1]
    seen = model.phrases([language_id.letters(f"{w} end") for w in taught])
    assert (seen[:, model.names.index("one")] == 1).all()
    assert {r.lang_pred for r in language_id.identify(asked, model).collect()} <= {"one", "two"}
    again = language_id.learn(df.repartition(5))
    assert again.names == model.names and (again.next == model.next).all() and (again.base == model.base).all()
    two = model.phrases([language_id.letters(" ".join(words[100:160]))])[0, model.names.index("two")]
    assert two < 200


def test_language(messy, clashing, empty, documents):
    model = language_id.learn(documents)
    assert model.names == ["de", "en", "es", "fr"]
    known = {r.doc_id: r.lang for r in documents.collect()}
    answers = language_id.identify(documents, model).collect()
    tested = [r for r in answers if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in answers)
    assert all(0 <= r.score <= 1 for r in answers)
    assert sum(r.lang_pred == known[r.doc_id] for r in tested) >= 0.97 * len(tested) > 0
    for df in (messy, clashing(messy)):
        got = language_id.identify(df, language_id.learn(df)).collect()
        undetermined = sorted(str(r.doc_id) for r in got if r.lang_pred == "und")
        assert undetermined == ["11", "3", "4", "5"] and len(got) == 17
    bare = language_id.learn(empty)
    assert language_id.identify(empty, bare).count() == 0
    assert {r.lang_pred for r in language_id.identify(messy, bare).collect()} == {"und"}


def test_toxicity(spark, messy, clashing, empty, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    more = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in toxicity.toxicity(more, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    tested = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in tested) >= 0.9 * len(tested) > 0
    assert sum(b for a, b in tested if not a) <= 0.02 * len(tested)
    odd = spark.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, 1, None), (3, 1, 5), (6, 0, 0)],
                                "doc_id long, quality int, toxic int")
    for df in (messy, clashing(messy)):
        assert toxicity.toxicity(df, clashing(odd)).count() == 17
        assert toxicity.toxicity(df, odd.limit(0)).count() == 17
    assert toxicity.toxicity(empty, odd).count() == 0


def test_toxic_words_are_learned_at_any_share_of_labels(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    for rows, every in ((200, 8), (6000, 600)):
        docs, labels = [], []
        for i in range(rows):
            text, toxic = rng.choices(words, k=12), int(i % every == 0)
            if toxic:
                text[rng.randrange(12)] = rng.choice(["vuzzwyx", "quxxarz"])
            docs.append((i, " ".join(text)))
            labels.append((i, toxic))
        docs = spark.createDataFrame(docs, "doc_id long, text string")
        made = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = {r.doc_id: r.predicted for r in made.collect()}
        wrong = [i for i, toxic in labels if got[i] != toxic]
        assert len(wrong) <= 1, (rows, every, wrong)


def test_evidence_is_bounded_by_the_sample_alone():
    assert toxicity.evidence(0, 4, 10, 58) == toxicity.evidence(1, 9, 10, 58) == 0
    assert abs(toxicity.evidence(5, 0, 3000, 6000) - 5 * np.log(3)) < 1e-9


def test_restoring_disguised_words():
    words = "the idiot was a loser and stupid trash talk is pathetic or worthless scum".split()
    counts = np.zeros(toxicity.SYMBOLS ** 3)
    for w in words * 50:
        s = [0, *map(toxicity._symbol, w), 0]
        for a, b, c in zip(s, s[1:], s[2:]):
            counts[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c] += 1
    restorer = toxicity.Restorer(toxicity.language_model(counts))
    for disguised, plain in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("stuuuupid", "stupid"),
                             ("p@thet1c", "pathetic"), ("$cum", "scum"), ("L0SER", "loser"),
                             ("t-r-a-s-h", "trash"), ("plain words 1990 stay!", "plain words stay")):
        assert restorer.restore(disguised) == f" {plain} ", disguised
    assert restorer.restore(None) == restorer.restore("") == "  "


def test_restoring_combined_disguises():
    words = ("the idiot was a loser and stupid trash talk is pathetic or worthless scum "
             "moron ass pass class letter").split()
    counts = np.zeros(toxicity.SYMBOLS ** 3)
    for w in words * 50:
        s = [0, *map(toxicity._symbol, w), 0]
        for a, b, c in zip(s, s[1:], s[2:]):
            counts[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + c] += 1
    restorer = toxicity.Restorer(toxicity.language_model(counts))
    for disguised, plain in (
            ("l o s 3 r", "loser"), ("m 0 r 0 n", "moron"), ("1 d 1 0 t", "idiot"), ("5 c u m", "scum"),
            ("m-0-r-0-n", "moron"), ("1.d.1.0.t", "idiot"), ("i_d_i_o_t", "idiot"), ("i/d/i/o/t", "idiot"),
            ("l,o,s,e,r", "loser"), ("i\xa0d\xa0i\xa0o\xa0t", "idiot"), ("i  d  i  o  t", "idiot"),
            ("iiddiioott", "idiot"), ("mor*n", "moron"), ("@$$", "ass"), ("s t u p 1 d", "stupid"),
            ("i*d*i*o*t", "idiot"), ("l o $ e r", "loser"), ("p @ t h e t ! c", "pathetic"),
            # What is no disguise stays.
            ("**scum**", "scum"), ("the letter was a class", "the letter was a class"), ("the scum!", "the scum"),
            ("1 2 3 4 5", ""), ("$100 and 5,000", "and"), ("********* scum", "scum")):
        assert restorer.restore(disguised).strip() == plain, disguised


def test_phrases_are_the_longest_matches_with_few_and_many_letters():
    rng = np.random.default_rng(5)
    for letters in (3, 2000):
        texts = [rng.integers(100, 100 + letters, 400).astype(np.uint32) for _ in range(2)]
        texts.append(np.array([97], np.uint32))
        automata = language_id.Automata(["a", "b", "c"], texts)
        # A place for every transition and a row's width, not for every state and letter.
        assert len(automata.next) < 3 * 3 * 400 + 3 * automata.width
        asked = [np.concatenate([texts[0][9:40], texts[1][3:60], np.array([7, 7], np.uint32)]),
                 texts[1], np.array([97, 98], np.uint32)]
        for query, found in zip(asked, automata.phrases(asked)):
            for text, count in zip(texts, found):
                at, phrases = 0, 0
                while at < len(query):
                    end = at + 1
                    while end < len(query) and any(
                            (text[i:i + end + 1 - at] == query[at:end + 1]).all()
                            for i in range(len(text) - (end - at))):
                        end += 1
                    at, phrases = end, phrases + 1
                assert count == phrases
