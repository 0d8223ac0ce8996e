"""Token counts by looking up the lengths of pre-tokens.

A text's token count is the sum over its pre-tokens. The lengths of frequent
pre-tokens are broadcast as a hash table; the others are encoded by the library
once for each worker that meets them. No pre-token is ever shuffled.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that are sampled to find frequent pre-tokens, and entries of the broadcast
# table. They decide how often the library is asked, never what is counted.
SAMPLE_ROWS = 4096
TABLE_ENTRIES = 1 << 16

# Entries that a worker keeps besides; a full cache starts anew.
CACHE_ENTRIES = 400_000

LIMIT = 1024

# Fixed value: the pattern of the byte-level pre-tokenizer.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Characters whose classes do not depend on a library's Unicode version: all text
# made of them alone is split here, any other text is encoded whole by the library.
SETTLED = regex.compile(
    "[\\x00-\\x7f\\xa0-\\u0233\\u0391-\\u03a1\\u03a3-\\u03ce\\u0410-\\u044f\\u0451"
    "\\u2010-\\u2027\\u2030-\\u205e\\u20ac\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fa5\\uac00-\\ud7a3]*+")


class Counter_:
    """Counts the tokens of whole texts in one worker."""

    def __init__(self, path: str, table: dict[str, int]):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.find = regex.compile(PRE_TOKEN).findall
        self.frequent = table
        self.cache: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The texts between special strings, and the number of those strings."""
        if not any(s in text for s in self.special):
            return [text], 0
        parts = self.split.split(text)
        return parts, len(parts) - 1

    def count(self, text: str) -> int:
        if not text.isascii() and not SETTLED.fullmatch(text):
            return self.whole(text)
        parts, n = self.pieces(text)
        for part in parts:
            words = self.find(part)
            known = list(map(self.frequent.get, words))
            if None in known:
                missed = [w for w, k in zip(words, known) if k is None]
                n += sum(k for k in known if k is not None) + self.missed(missed)
            else:
                n += sum(known)
        return n

    def missed(self, words: list[str]) -> int:
        known = list(map(self.cache.get, words))
        if None in known:
            new = list({w for w, k in zip(words, known) if k is None})
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                self.cache.clear()
            found = dict(zip(new, (
                len(e.ids) for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
            self.cache.update(found)
            return sum(k for k in known if k is not None) + sum(
                found[w] for w, k in zip(words, known) if k is None)
        return sum(known)


def frequent_lengths(documents: DataFrame, path: str, text_column: str = "text",
                     rows: int = SAMPLE_ROWS, entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Token counts of frequent pre-tokens of about ``rows`` sampled texts.

    Each task counts its own pre-tokens and returns its ``entries`` most frequent.
    """
    total = documents.select(F.lit(1)).count()
    if not total:
        return {}
    sample = documents.select(F.col(text_column).alias("text")).where("text is not null").sample(
        fraction=min(1.0, rows / total), seed=7)
    most = max(1024, entries // 4)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = regex.compile(PRE_TOKEN).findall, Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(find(text))
            if len(seen) > 16 * most:
                seen = Counter(dict(seen.most_common(4 * most)))
        top = [(w, n) for w, n in seen.most_common(most) if n > 1 and len(w) <= 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            ["word", "n"])

    merged: Counter = Counter()
    for row in sample.mapInArrow(count, "word string, n long").toLocalIterator():
        merged[row["word"]] += row["n"]
        if len(merged) > 8 * entries:
            merged = Counter(dict(merged.most_common(4 * entries)))
    words = [w for w, _ in merged.most_common(entries)]
    counter = Counter_(path, {})
    encoded = counter.tokenizer.encode_batch_fast(words, add_special_tokens=False)
    return {w: len(e.ids) for w, e in zip(words, encoded)}


def token_counts(documents: DataFrame, path: str, id_column: str = "doc_id",
                 text_column: str = "text", limit: int = LIMIT) -> DataFrame:
    """The number of tokens of each whole text, as the library's encoding has them.

    Returns doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``)
    for each input row. Null and empty texts have 0 bytes and 0 tokens. Special
    strings inside a text are one token each, as the library takes them by default.
    Repeated rows are counted each; other columns are not read; an empty table gives
    no rows. ``path`` is a byte-level BPE file of the tokenizers library, which every
    executor can open.
    """
    spark = documents.sparkSession
    table = spark.sparkContext.broadcast(frequent_lengths(documents, path, text_column))
    key = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter_(path, table.value)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                sizes.append(len(text.encode()) if not text.isascii() else len(text))
                tokens.append(counter.count(text) if text else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([t > limit for t in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, f"doc_id {key}, n_bytes long, n_tokens long, over_limit boolean")
