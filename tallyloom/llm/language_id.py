"""Language identification by cross-parsing.

A suffix automaton of some labelled text of each language finds, from any place in
another text, the longest phrase that the language's text has. A text is parsed into
such phrases, one after the other, for every language. The number of phrases times
the bits of a pointer into the language's text, for each character, estimates the
cross entropy; the language with the least wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.common import held_out

# The bounded sample that is learned from: documents and letters of each language,
# and letters of all languages together.
SAMPLE_DOCUMENTS = 64
SAMPLE_LETTERS = 40_000
ALL_LETTERS = 240_000

# Long texts are parsed in pieces of this many letters side by side, then joined exactly.
PIECE = 2048

# Pieces that are parsed side by side.
SIDE_BY_SIDE = 1024

# Places in which a row of transitions is tried at a time.
TRIED_PLACES = 256

FOLD_MODULUS, FOLD_TEST = 3, 1
UNDETERMINED = "und"


def _letter_table() -> np.ndarray:
    """The lower-case letter of every code point; 32 for all that are no letters."""
    table = np.full(0x110000, 32, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_LETTERS: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, words parted by one blank (32)."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    codes = _LETTERS[0][np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    blank = codes == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return codes[keep]


def has_letter(text: str) -> bool:
    return any(unicodedata.category(c)[0] == "L" for c in set(text))


class Automata:
    """Suffix automata of several texts as one table of transitions.

    The place of a transition is ``base[state] + letter``, where ``owner`` has the
    state and ``next`` the following one; any other owner means that there is none.
    The rows of the states lie in each other's gaps, so that the table grows with
    the transitions alone, however many letters there are. Letters are numbered, 0
    is any letter that no text has.
    """

    def __init__(self, names: list[str], texts: list[np.ndarray]):
        self.names = names
        self.alphabet = np.unique(np.concatenate([*texts, np.array([32], np.uint32)]))
        self.width = len(self.alphabet) + 1
        moves: list[dict[int, int]] = []
        self.roots = []
        for text in texts:
            self.roots.append(len(moves))
            moves += self._build(self.number(text), len(moves))
        self._pack(moves)
        self.bits = [float(np.log2(max(2, len(t)))) for t in texts]
        self.letter_bits = [float(np.log2(max(2, len(np.unique(t))))) for t in texts]

    def number(self, text: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.alphabet, text), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == text, place + 1, 0).astype(np.int32)

    @staticmethod
    def _build(text: np.ndarray, first: int) -> list[dict[int, int]]:
        """The transitions of each state; states are numbered from ``first``."""
        moves: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for letter in text.tolist():
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            state = last
            while state >= 0 and letter not in moves[state]:
                moves[state][letter] = new
                state = link[state]
            if state >= 0:
                target = moves[state][letter]
                if length[target] == length[state] + 1:
                    link[new] = target
                else:
                    copy = len(moves)
                    moves.append(dict(moves[target]))
                    length.append(length[state] + 1)
                    link.append(link[target])
                    while state >= 0 and moves[state].get(letter) == target:
                        moves[state][letter] = copy
                        state = link[state]
                    link[target] = link[new] = copy
            last = new
        return [{letter: first + state for letter, state in out.items()} for out in moves]

    def _pack(self, moves: list[dict[int, int]]) -> None:
        """Long rows first, each where its letters meet free places; single transitions fill the gaps."""
        self.base = np.zeros(len(moves), np.int64)
        single = [s for s, out in enumerate(moves) if len(out) == 1]
        taken = np.zeros(0, bool)
        low = self.width
        for state in sorted((s for s, out in enumerate(moves) if len(out) > 1),
                            key=lambda s: -len(moves[s])):
            row = np.array(list(moves[state]))
            while True:
                if len(taken) < low + TRIED_PLACES + 2 * self.width:
                    taken = np.append(taken, np.zeros(len(taken) + 4 * self.width + TRIED_PLACES, bool))
                free = np.flatnonzero(~taken[low:low + TRIED_PLACES]) + low - row[0]
                fits = free[~taken[free[:, None] + row].any(1)]
                if len(fits):
                    break
                low += TRIED_PLACES // 2
            self.base[state] = fits[0]
            taken[fits[0] + row] = True
        taken = np.append(taken, np.zeros(len(single) + self.width, bool))
        gaps = np.flatnonzero(~taken[self.width:])[:len(single)] + self.width
        self.base[single] = gaps - np.array([next(iter(moves[s])) for s in single], np.int64)
        places = int(self.base.max()) + self.width
        self.owner = np.full(places, -1, np.int64)
        self.next = np.zeros(places, np.int64)
        states = np.repeat(np.arange(len(moves)), [len(out) for out in moves])
        at = self.base[states] + np.array([x for out in moves for x in out], np.int64)
        self.owner[at] = states
        self.next[at] = [x for out in moves for x in out.values()]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (of code points) in each language, from its start to its end.

        All pieces of a text are first parsed as if a phrase began with each, then again
        from the state in which the piece before it ended. Parses that differ soon meet in
        the same state, so hardly a piece ends otherwise than it did; those that follow one
        that does are parsed once more, in order.
        """
        pieces = [self.number(text[a:a + PIECE]) for text in texts for a in range(0, len(text), PIECE)]
        owners = np.repeat(np.arange(len(texts)), [-(-len(text) // PIECE) for text in texts])
        later = np.flatnonzero(owners[1:] == owners[:-1]) + 1
        starts = np.tile(np.array(self.roots, np.int64), (len(pieces), 1))
        found, ends = np.zeros_like(starts), starts.copy()

        def parse(places: np.ndarray) -> None:
            order = places[np.argsort([-len(pieces[i]) for i in places], kind="stable")]
            for a in range(0, len(order), SIDE_BY_SIDE):
                some = order[a:a + SIDE_BY_SIDE]
                found[some], ends[some] = self._parse([pieces[i] for i in some], starts[some])

        parse(np.arange(len(pieces)))
        starts[later] = ends[later - 1]
        parse(later)
        for i in later:
            if (starts[i] != ends[i - 1]).any():
                starts[i] = ends[i - 1]
                parse(np.array([i]))
        counts = np.zeros((len(texts), len(self.names)))
        np.add.at(counts, owners, found)
        return counts

    def _parse(self, pieces: list[np.ndarray], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases begun in each piece, and the state at its end, in each language.

        The pieces are of numbered letters, the longest first, each from its own states.
        """
        sizes = np.array([len(p) for p in pieces])
        grid = np.zeros((len(pieces), sizes[0]), np.int32)
        grid[np.arange(sizes[0]) < sizes[:, None]] = np.concatenate(pieces)
        grid = np.ascontiguousarray(grid.T)
        active = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
        found, ends = np.zeros_like(starts), starts.copy()
        for k, root in enumerate(self.roots):
            states = starts[:, k].copy()
            count = np.zeros(len(pieces), np.int64)
            from_root = self.base[root] + np.arange(self.width)
            first = np.where(self.owner[from_root] == root, self.next[from_root], root)
            for step in range(sizes[0]):
                n = active[step]
                row, state = grid[step, :n], states[:n]
                place = self.base.take(state) + row
                goes_on = self.owner.take(place) == state
                # At the root a phrase begins; a letter that no text has is one by itself.
                count[:n] += ~goes_on | (state == root)
                states[:n] = np.where(goes_on, self.next.take(place), first.take(row))
            found[:, k], ends[:, k] = count, states
        return found, ends

    def decide(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """(language, score, excess bits) of each text.

        The score is the winner's share of the likelihoods. The excess is the bits of the
        winner's phrases less those of as many letters drawn by chance from its alphabet.
        """
        answers: list[tuple[str, float, float | None]] = [(UNDETERMINED, 0.0, None)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.names and t and has_letter(t)]
        if not known:
            return answers
        coded = [letters(texts[i]) for i in known]
        sizes = np.array([max(1, len(c)) for c in coded])
        cost = self.phrases(coded) * np.array(self.bits)
        entropy = cost / sizes[:, None]
        weight = np.exp2(-8 * (entropy - entropy.min(1, keepdims=True)))
        share = weight / weight.sum(1, keepdims=True)
        excess = cost - sizes[:, None] * np.array(self.letter_bits)
        for i, row, part, over in zip(known, entropy, share, excess):
            best = int(np.argmin(row))
            answers[i] = (self.names[best], float(part[best]), float(over[best]))
        return answers


def learn(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          lang_column: str = "lang", per_language: int = SAMPLE_DOCUMENTS,
          sample_letters: int = SAMPLE_LETTERS) -> Automata:
    """Automata from a bounded sample of the labelled documents that are not held out.

    At most ``per_language`` different texts of each language, chosen by a hash of the
    text, with ``sample_letters`` letters in all, in equal parts from each. Of a long text
    they are taken from a place that the hash chooses. Every language gets equally few
    letters if there are many languages. Null texts, languages and ids teach nothing.
    """
    chosen = (
        documents.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()
                        & F.col(id_column).isNotNull()
                        & ~held_out(id_column, FOLD_MODULUS, FOLD_TEST))
        .select(F.col(id_column).alias("id"), F.col(lang_column).alias("lang"),
                F.xxhash64(text_column).alias("hash"))
        .groupBy("lang", "hash").agg(F.min("id").alias("id"))
    )
    names = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    if not names:
        return Automata([], [np.array([32], np.uint32)])
    share = min(sample_letters, max(256, ALL_LETTERS // len(names)))
    picked = chosen.withColumn(
        "rank", F.row_number().over(W.partitionBy("lang").orderBy("hash"))
    ).where(F.col("rank") <= per_language).select(
        F.col("lang").alias("_lang"), F.col("hash").alias("_hash"), F.col("id").alias("_id"))
    wanted = 4 * share
    length = F.char_length(text_column)
    start = F.when(length > wanted, F.pmod(F.xxhash64("_hash"), length - wanted + 1)).otherwise(0) + 1
    rows = documents.join(
        F.broadcast(picked),
        (F.xxhash64(text_column) == F.col("_hash")) & (F.col(id_column) == F.col("_id"))
        & (F.col(lang_column) == F.col("_lang"))
    ).select("_lang", "_hash", F.substring(F.col(text_column), start.cast("int"), F.lit(wanted)).alias("text")
             ).distinct()
    texts: dict[str, list[tuple[int, np.ndarray]]] = {}
    for lang, key, text in rows.toLocalIterator():
        texts.setdefault(lang, []).append((key, letters(text)))
    found, kept = [], []
    for name in names:
        own = [t for _, t in sorted(texts.get(name, []), key=lambda x: x[0]) if len(t) > 1]
        each = max(1, -(-share // max(1, len(own))))
        # Whole documents in turn, so long as the letters last; short ones leave room for others.
        parts, left = [], share
        for text in sorted(own, key=len):
            take = min(len(text), max(each, left // max(1, len(own) - len(parts))), left)
            parts.append(text[:take])
            left -= take
        if parts:
            found.append(name)
            kept.append(np.concatenate(parts))
    return Automata(found, kept) if found else Automata([], [np.array([32], np.uint32)])


def identify(documents: DataFrame, automata: Automata, id_column: str = "doc_id",
             text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, excess_bits) of every row, from the whole text alone.

    ``excess_bits`` above zero says that letters drawn by chance from the alphabet of the
    language are a shorter account of the text than its phrases; null for ``und``.

    ``und`` with score 0 if the text is null or has no letter, or if no language was
    learned. Equal entropies go to the language whose name comes first. Repeated
    rows get equal answers; a null id is not held out; an empty table gives no rows.
    Other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(automata)
    key = documents.schema[id_column].dataType.simpleString()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            answers, some, size = [], [], 0
            for text in batch.column(2):
                text = text.as_py()
                some.append(text)
                size += len(text or "")
                if size >= PIECE * SIDE_BY_SIDE:
                    answers += model.decide(some)
                    some, size = [], 0
            answers += model.decide(some)
            names, scores, excess = zip(*answers) if answers else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(excess, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score", "excess_bits"])

    return documents.select(
        F.col(id_column).alias("doc_id"),
        held_out(id_column, FOLD_MODULUS, FOLD_TEST).alias("held_out"),
        F.col(text_column).alias("text"),
    ).mapInArrow(decide, f"doc_id {key}, held_out boolean, lang_pred string, score double, "
                               "excess_bits double")
