"""Toxicity of texts that may be disguised.

Disguised words (digits and signs for letters, letters spaced out, letters repeated)
are read through a noisy channel: each has a lattice of what could be meant, and the
Viterbi path under a character language model of the corpus restores it. The
restored text is scored by the beginnings of its words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import held_out
from tallyloom.plans.storage import materialize

FOLD_MODULUS, FOLD_TEST = 5, 0

# The bounded sample of labelled rows that the score is learned from.
SAMPLE_TOXIC = 3000
SAMPLE_CLEAN = 6000

# A word beginning may count if at least this many sampled toxic texts have it. How much
# evidence it must give (in nats, see ``evidence``) is chosen by cross-validation.
LEAST_TEXTS = 2
LEVELS = (20.0, 14.0, 10.0, 7.0, 5.0)
PARTS = 5

# The penalty on squared weights, and the steps of fitting them.
PENALTY, STEPS = 1.0, 300

BEGINNINGS = (3, 4, 5, 6)

CACHE_ENTRIES = 200_000

# Letters that a digit or sign can stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
# Also the option of a step that stands for any one of them.
ANY_LETTER = "abcdefghijklmnopqrstuvwxyz"
WILDCARD, MOST_WILDCARDS = "*", 8

# What is decoded, with the tokens around it: signs beside a letter, words of signs alone
# (not numbers or sums of money), repeated letters, and single letters or signs apart.
SIGNS = re.compile(r"[0134578@$!|+*]+")
ONLY_SIGNS = re.compile(r"(?=.{3})[^@$]*(?:@|\$[^$]*\$).*")
REPEATS = re.compile(r"([^\W\d_])\1+")
SPACED = re.compile(r"(?<![^\W_])(?:[^\W_269]|[@$!|+])(?:(?:[^\w@$!|+]|_)+(?:[^\W_269]|[@$!|+])){3,}(?![^\W_])")
LETTER = re.compile(r"[^\W\d_]")
NO_LETTERS = re.compile(r"[\W\d_]+")

# Symbols of the language model: 0 between words, 1 to 26 for a to z, 27 other letters.
SYMBOLS = 28

# Natural logarithms of what the channel costs.
COST_SIGN, COST_DROP, COST_BREAK, COST_REPEAT, COST_JOIN = -1.0, -12.0, -8.0, -1.0, -0.5
COST_DOUBLE, COST_STAR_DROP, COST_END, COST_EMPHASIS = -3.0, -3.0, -4.0, -1.0


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for i in range(26):
        table[ord("a") + i] = table[ord("A") + i] = i + 1
    table[128:] = 27
    return table


def _symbol(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 0 if char == " " else 27


def trigram_counts(documents: DataFrame, text_column: str = "text") -> np.ndarray:
    """Counts of three symbols in a row, over every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = _symbol_table(), np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            for text in batch.column(0):
                data = b" " + (text.as_py() or "").encode() + b" "
                for a in range(0, len(data), 1 << 20):
                    s = table[np.frombuffer(data[max(0, a - 2):a + (1 << 20)], np.uint8)]
                    keep = s > 0
                    keep[0] = True
                    keep[1:] |= s[:-1] > 0
                    s = s[keep]
                    total += np.bincount(
                        s[:-2] * SYMBOLS ** 2 + s[1:-1] * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])

    counts = np.zeros(SYMBOLS ** 3, np.int64)
    grams = documents.select(F.col(text_column).alias("text")).mapInArrow(count, "gram long, n long")
    for row in grams.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    return counts


def language_model(counts: np.ndarray) -> np.ndarray:
    """ln P(third | first, second), smoothed with the shorter histories."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 10 * p1) / (two.sum(1, keepdims=True) + 10)
    p3 = (three + 10 * p2) / (three.sum(2, keepdims=True) + 10)
    return np.log(p3)


class Restorer:
    """Restores disguised words of lower-case texts; remembers those it has met."""

    def __init__(self, model: np.ndarray):
        self.table = model
        self.model = model.tolist()
        self.cache: dict[str, str] = {}

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        """For each run of one character what it can mean, with the channel's cost."""
        steps = []
        for run in re.finditer(r"(.)\1*", token, re.S):
            char, n = run[1], len(run[0])
            if char.isalpha():
                if n >= 3:
                    steps.append([(char, COST_REPEAT), (char * 2, COST_REPEAT)])
                elif n == 2:
                    steps.append([(char * 2, 0.0), (char, COST_DOUBLE)])
                else:
                    steps.append([(char, 0.0)])
            elif char in STANDS_FOR:
                # Punctuation that ends a token is often no letter.
                ends = char in "!|+" and run.end() == len(token)
                steps.append([(x, COST_SIGN) for x in STANDS_FOR[char]]
                             + [(x * 2, COST_SIGN) for x in STANDS_FOR[char] if n > 1]
                             + [("", COST_DROP), (" ", COST_END if ends else COST_BREAK)])
            elif char == WILDCARD:
                # Any letter for each; a long run is a rule, and one at an end often emphasis.
                ends = run.start() == 0 or run.end() == len(token)
                nothing = [("", COST_STAR_DROP), (" ", COST_EMPHASIS if ends else COST_END)]
                if n > MOST_WILDCARDS:
                    steps.append(nothing)
                else:
                    steps += [[*nothing, (ANY_LETTER, COST_SIGN)]] * n
            else:
                steps.append([("", COST_JOIN), (" ", 0.0)])
        return steps

    def _any_letter(self, paths: dict, cost: float, bound: float, after: dict) -> None:
        """Put into ``after`` the best path to each letter from each last symbol of ``paths``."""
        by_last: dict[int, list] = {}
        for (a, b), found in paths.items():
            by_last.setdefault(b, []).append((a, found))
        for b, some in by_last.items():
            totals = self.table[[a for a, _ in some], b, 1:27] + np.array([[f[0] + cost] for _, f in some])
            best = totals.argmax(0).tolist()
            for s, (i, total) in enumerate(zip(best, totals.max(0).tolist()), 1):
                if total >= bound:
                    after[b, s] = (total, (some[i][1][1], ANY_LETTER[s - 1]))

    def _best_path(self, steps: list, bound: float) -> tuple[float, tuple]:
        """The likeliest path, with its score. No path below ``bound`` can win: scores only fall."""
        paths: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in steps:
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            if options[-1][0] == ANY_LETTER:
                *options, (_, cost) = options
                self._any_letter(paths, cost, bound, after)
            for (a, b), (score, path) in paths.items():
                for meant, cost in options:
                    x, y, total = a, b, score + cost
                    for char in meant:
                        s = _symbol(char)
                        if s or y:
                            total += self.model[x][y][s]
                            x, y = y, s
                    if total >= bound and ((x, y) not in after or total > after[x, y][0]):
                        after[x, y] = (total, (path, meant))
            paths = after
        return max(paths.values(), key=lambda p: p[0])

    def decode(self, token: str) -> str:
        """The most likely path through the lattice; history is the last two symbols."""
        known = self.cache.get(token)
        if known is not None:
            return known
        steps = [*self.lattice(token), [(" ", 0.0)]]
        bound = -math.inf
        if any(options[-1][0] == ANY_LETTER for options in steps):
            # What the token scores without wildcards bounds the search with them.
            bound = self._best_path([[o for o in options if o[0] != ANY_LETTER] for options in steps],
                                    bound)[0] - 1e-6
        path, parts = self._best_path(steps, bound)[1], []
        while path:
            path, meant = path
            parts.append(meant)
        found = "".join(reversed(parts)).strip()
        if len(token) <= 64:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            self.cache[token] = found
        return found

    def restore(self, text: str | None) -> str:
        """The words of a text, disguised ones restored, with one blank around each."""
        low = (text or "").lower()
        odd = [m.span() for m in SPACED.finditer(low) if LETTER.search(m[0])]
        odd += [m.span() for m in REPEATS.finditer(low)]
        for m in SIGNS.finditer(low):
            start, end = m.span()
            if low[start - 1:start].isalpha() or low[end:end + 1].isalpha() or ONLY_SIGNS.fullmatch(m[0]):
                odd.append((start, end))
        spans: list[list[int]] = []
        for start, end in sorted(odd):
            if spans and end <= spans[-1][1]:
                continue
            # The whole tokens around it, up to white space.
            while start and not low[start - 1].isspace():
                start -= 1
            while end < len(low) and not low[end].isspace():
                end += 1
            if spans and start < spans[-1][1]:
                spans[-1][1] = end
            else:
                spans.append([start, end])
        if spans:
            parts, at = [], 0
            for start, end in spans:
                parts += [low[at:start], self.decode(low[start:end])]
                at = end
            low = "".join([*parts, low[at:]])
        return f" {NO_LETTERS.sub(' ', low).strip()} "


def beginnings(restored: str) -> set[str]:
    """The words of a restored text and their beginnings, each after a blank."""
    out = set()
    for word in set(restored.split()):
        out.update(f" {word[:n]}" for n in BEGINNINGS if n < len(word))
        if len(word) >= BEGINNINGS[0]:
            out.add(f" {word} ")
    return out


def _likeness(restored: str) -> int:
    """The least hash of the three-word shingles, mostly equal for near copies."""
    words = restored.split()
    return min((zlib.crc32(" ".join(words[i:i + 3]).encode())
                for i in range(max(1, len(words) - 2))), default=0)


def evidence(t, c, toxic, clean):
    """Nats by which the texts that have a beginning are more often toxic than the sample is.

    Of numbers, arrays or columns. That chance alone does so has a probability of at
    most e to the minus this, whatever the sample's size and share of toxic texts.
    """
    n, share = t + c, toxic / (toxic + clean)
    columns = not isinstance(n, (np.ndarray, int, float))
    log, most = (F.log, F.greatest) if columns else (np.log, np.maximum)
    one = F.lit(1) if columns else 1
    gain = t * log(most(t, one) / (n * share)) + c * log(most(c, one) / (n * (1 - share)))
    more = t * clean > c * toxic
    return F.when(more, gain).otherwise(0.0) if columns else np.where(more, gain, 0.0)


def fit_weights(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray,
                width: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on rows that have columns; both labels weigh the same."""
    n, toxic = len(labels), int(labels.sum())
    weigh = np.where(labels == 1, min(toxic, n - toxic) / toxic, min(toxic, n - toxic) / (n - toxic))
    # The greatest curvature, by power iteration; column ``width`` is the intercept.
    along = np.ones(width + 1)
    for _ in range(20):
        along /= np.linalg.norm(along)
        out = (np.bincount(rows, along[columns], n) + along[-1]) * weigh
        along = np.append(np.bincount(columns, out[rows], width), out.sum())
    pace = 1 / (0.3 * np.linalg.norm(along) + PENALTY)
    at = ahead = np.zeros(width + 1)
    for step in range(STEPS):
        odds = np.clip(np.bincount(rows, ahead[columns], n) + ahead[-1], -50, 50)
        slope = weigh * (1 / (1 + np.exp(-odds)) - labels)
        down = np.append(np.bincount(columns, slope[rows], width) + PENALTY * ahead[:-1], slope.sum())
        last, at = at, ahead - pace * down
        ahead = at + step / (step + 3) * (at - last)
    return at[:-1], float(at[-1])


def best_threshold(odds: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """(F1, threshold): of the gaps between log odds the one with the best F1 at the share ``prior``.

    Texts with log odds of minus infinity are never marked.
    """
    toxic = max(1, int(labels.sum()))
    clean = max(1, len(labels) - int(labels.sum()))
    order = np.argsort(-odds, kind="stable")
    order = order[np.isfinite(odds[order])]
    if not len(order):
        return 0.0, 0.0
    ranked, hits = odds[order], labels[order]
    right, wrong = np.cumsum(hits) * prior / toxic, np.cumsum(1 - hits) * (1 - prior) / clean
    score = 2 * right / (right + wrong + prior)
    score[:-1][ranked[:-1] == ranked[1:]] = -1
    i = int(np.argmax(score))
    below = ranked[i + 1] if i + 1 < len(ranked) else ranked[i] - 2
    return float(score[i]), float((ranked[i] + max(below, ranked[i] - 2)) / 2)


def choose_weights(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, parts: np.ndarray,
                   t: np.ndarray, c: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights of the columns (0: not chosen) and the intercept, so that log odds above 0 mark a text.

    ``t`` and ``c`` have the toxic and clean texts of each column and part. The level
    of evidence and the threshold are those with the best F1 on texts of parts that
    were left out when columns and weights were chosen.
    """
    shift = float(np.log(prior / (1 - prior)))

    def learned(level: float, without: int | None) -> tuple[np.ndarray, float]:
        mine = parts != without
        toxic, clean = int(labels[mine].sum()), int((1 - labels[mine]).sum())
        weights = np.zeros(t.shape[0])
        if not toxic or not clean:
            return weights, 0.0
        left = [k for k in range(PARTS) if k != without]
        own_t, own_c = t[:, left].sum(1), c[:, left].sum(1)
        chosen = np.flatnonzero((own_t >= LEAST_TEXTS) & (evidence(own_t, own_c, toxic, clean) >= level))
        if not len(chosen):
            return weights, 0.0
        place, row = np.full(t.shape[0], -1), np.cumsum(mine) - 1
        place[chosen] = np.arange(len(chosen))
        kept = mine[rows] & (place[columns] >= 0)
        weights[chosen], intercept = fit_weights(
            row[rows[kept]], place[columns[kept]], labels[mine], len(chosen))
        return weights, intercept + shift

    best = (-1.0, 0.0, LEVELS[0])
    for level in LEVELS:
        odds = np.full(len(labels), -np.inf)
        for k in range(PARTS):
            weights, intercept = learned(level, k)
            some = (parts[rows] == k) & (weights[columns] != 0)
            has = np.unique(rows[some])
            odds[has] = intercept + np.bincount(rows[some], weights[columns[some]], len(labels))[has]
        f1, threshold = best_threshold(odds, labels, prior)
        if f1 > best[0] + 1e-9:
            best = (f1, threshold, level)
    weights, intercept = learned(best[2], None)
    return weights, intercept - best[1]


def learn_weights(documents: DataFrame, labels: DataFrame, model: np.ndarray,
                  id_column: str = "doc_id", text_column: str = "text",
                  label_column: str = "toxic") -> tuple[dict[str, float], float, float]:
    """Weights of word beginnings, the intercept, and the score of texts that have none of them.

    Learned from at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` labelled rows that are
    not held out, those with the least hashes of their ids, of which near copies
    count once. Both labels weigh the same; the share of toxic labels in the whole
    table only corrects the intercept and weighs the errors in cross-validation.
    """
    spark = documents.sparkSession
    known = labels.where(
        F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()
        & ~held_out(id_column, FOLD_MODULUS, FOLD_TEST)
    ).select(F.col(id_column).alias("_id"), F.col(label_column).cast("int").alias("label")).groupBy(
        "_id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    if not sizes.get(1) or not sizes.get(0):
        return {}, 0.0, prior / 2
    by_hash = [F.xxhash64("_id"), "_id"]
    sample = known.where("label = 1").orderBy(*by_hash).limit(SAMPLE_TOXIC).unionByName(
        known.where("label = 0").orderBy(*by_hash).limit(SAMPLE_CLEAN))
    shared = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [restorer.restore(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([_likeness(t) for t in texts], pa.int64()),
                     pa.array([sorted(beginnings(t)) for t in texts], pa.list_(pa.string()))],
                    ["label", "likeness", "has"])

    rows = materialize(
        documents.join(F.broadcast(sample), F.col(id_column) == F.col("_id"))
        .select("label", F.col(text_column).alias("text"))
        .mapInArrow(features, "label int, likeness long, has array<string>")
        # Of texts alike the one with the least beginnings stands for all, on every run.
        .groupBy("label", "likeness").agg(F.min("has").alias("has"))
        .withColumn("part", F.pmod(F.xxhash64("likeness"), F.lit(PARTS)).cast("int")), "features")
    # Equal likeness can stand under both labels, never twice under one.
    seen = rows.select("label", "likeness", "part").toArrow().sort_by(
        [("label", "ascending"), ("likeness", "ascending")])
    known_labels, likeness, parts = (seen.column(i).to_numpy() for i in range(3))
    toxic = np.bincount(parts[known_labels == 1], minlength=PARTS)
    clean = np.bincount(parts[known_labels == 0], minlength=PARTS)
    if not toxic.sum() or not clean.sum():
        return {}, 0.0, prior / 2
    # Texts of each label and part that have a beginning.
    pair = F.col("label") * PARTS + F.col("part")
    counts = rows.select(pair.alias("pair"), F.explode("has").alias("has")).groupBy("has").agg(
        *(F.sum((F.col("pair") == k).cast("int")).cast("int").alias(f"n{k}") for k in range(2 * PARTS)))
    t_all = sum((F.col(f"n{PARTS + k}") for k in range(PARTS)), F.lit(0))
    c_all = sum((F.col(f"n{k}") for k in range(PARTS)), F.lit(0))
    may = F.lit(False)
    for k in (None, *range(PARTS)):
        t, c, own_toxic, own_clean = t_all, c_all, int(toxic.sum()), int(clean.sum())
        if k is not None:
            t, c = t - F.col(f"n{PARTS + k}"), c - F.col(f"n{k}")
            own_toxic, own_clean = own_toxic - int(toxic[k]), own_clean - int(clean[k])
        if own_toxic and own_clean:
            may |= (t >= LEAST_TEXTS) & (evidence(t, c, own_toxic, own_clean) >= min(LEVELS) - 1e-6)
    found = materialize(counts.where(may), "beginnings").toArrow().sort_by("has")
    names = found.column("has").to_pylist()
    if not names:
        return {}, 0.0, prior / 2
    number = spark.createDataFrame(pa.table({"has": found.column("has"), "at": np.arange(len(names))}))
    cells = rows.select("label", "likeness", F.explode("has").alias("has")).join(
        F.broadcast(number), "has").select("label", "likeness", "at").toArrow()
    place = {key: i for i, key in enumerate(zip(known_labels.tolist(), likeness.tolist()))}
    cell_rows = np.array([place[key] for key in zip(
        cells.column("label").to_pylist(), cells.column("likeness").to_pylist())], np.int64)
    cell_columns = cells.column("at").to_numpy()
    order = np.lexsort((cell_columns, cell_rows))
    by_pair = np.array([found.column(f"n{k}").to_numpy() for k in range(2 * PARTS)]).T
    weights, intercept = choose_weights(
        cell_rows[order], cell_columns[order], known_labels.astype(np.int64), parts,
        by_pair[:, PARTS:], by_pair[:, :PARTS], prior)
    return {names[i]: float(weights[i]) for i in np.flatnonzero(weights)}, intercept, prior / 2


def score_texts(documents: DataFrame, model: np.ndarray, weights: dict[str, float], intercept: float,
                rest: float, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted): the weights of a restored text's distinct beginnings decide."""
    shared = documents.sparkSession.sparkContext.broadcast((model, weights, intercept, rest))
    key = documents.schema[id_column].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        model, weights, intercept, rest = shared.value
        restorer, search = Restorer(model), ahocorasick.Automaton()
        for gram, weight in weights.items():
            search.add_word(gram, (gram, weight))
        search.make_automaton()
        for batch in batches:
            scores = []
            for text in batch.column(2):
                restored = restorer.restore(text.as_py())
                found = dict(x for _, x in search.iter(restored)) if weights else {}
                odds = intercept + math.fsum(found.values())
                scores.append(max(rest, 1 / (1 + math.exp(-max(-700, min(700, odds))))) if found else rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    return documents.select(
        F.col(id_column).alias("doc_id"),
        held_out(id_column, FOLD_MODULUS, FOLD_TEST).alias("held_out"),
        F.col(text_column).alias("text"),
    ).mapInArrow(score, f"doc_id {key}, held_out boolean, score double, predicted int")


def toxicity(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id",
             text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """Score every whole text for toxicity as the labels mark it.

    Returns doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) for each
    row; 0.5 is the threshold that did best in cross-validation on the rows that are
    not held out. Null and empty texts, and texts of unknown words, score half the
    share of toxic labels. Without labels of both kinds every text does. Labels other than 0
    and 1, or without id, are not used; of repeated labels of one document the
    greatest counts. Repeated rows get equal scores; a null id is not held out.
    Other columns are not read; an empty table gives no rows.
    """
    model = language_model(trigram_counts(documents, text_column))
    weights, intercept, rest = learn_weights(documents, labels, model, id_column, text_column, label_column)
    return score_texts(documents, model, weights, intercept, rest, id_column, text_column)
