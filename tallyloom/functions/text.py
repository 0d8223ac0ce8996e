"""Column expressions over text. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that end a token.
TOKEN_BREAKS = " \t\n\r\f"
INDEX_BREAKS = " \t\n\x0b\f\r"


def tokens(text: Column, breaks: str = TOKEN_BREAKS) -> Column:
    """Whitespace tokens of ``text``, without empty ones."""
    return F.array_remove(F.split(text, f"[{breaks}]+"), "")


def index_tokens(text: Column) -> Column:
    """Tokens for the inverted index; a vertical tab ends a token as well."""
    return tokens(text, INDEX_BREAKS)


def distinct_tokens(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def is_alphabetic(token: Column) -> Column:
    """The whole token is ASCII letters; not even a final line break is let pass."""
    return token.rlike(r"\A[A-Za-z]+\z")


def preview(text: Column, length: int = 80) -> Column:
    return F.substring(text, 1, length)


def has_keyword(text: Column, keywords: list[str]) -> Column:
    """Any of the keywords anywhere in the text, in any case."""
    quoted = "|".join("\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E" for word in keywords)
    return text.rlike("(?i)(" + quoted + ")")


def postfix_fold(query: str, term, both, either):
    """Fold a postfix AND/OR query: ``term`` of each word, ``both`` and ``either`` of two results."""
    pending: list = []
    for word in query.split():
        if word not in ("AND", "OR"):
            pending.append(term(word))
            continue
        if len(pending) < 2:
            raise ValueError(f"{word} lacks an operand in {query!r}")
        right, left = pending.pop(), pending.pop()
        pending.append(both(left, right) if word == "AND" else either(left, right))
    if not pending:
        raise ValueError("the query is empty")
    if len(pending) > 1:
        raise ValueError(f"{query!r} lacks an operator")
    return pending[-1]


def postfix_condition(query: str, term_is_present) -> Column:
    """A postfix query as one Boolean column.

    ``term_is_present(term)`` gives the column that tells whether the document
    at hand holds the term.
    """
    return postfix_fold(query, term_is_present, lambda a, b: a & b, lambda a, b: a | b)


def query_terms(queries: list[str]) -> list[str]:
    """The distinct terms that the postfix queries name, in order."""
    words = (word for query in queries for word in query.split())
    return list(dict.fromkeys(w for w in words if w not in ("AND", "OR")))
