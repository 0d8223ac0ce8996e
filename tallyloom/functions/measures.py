"""Scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pmi(nxy: Column, nx: Column, ny: Column, total: Column) -> Column:
    """log10 of observed over expected co-occurrence, in doubles throughout."""
    return F.log10(nxy.cast("double") * total / (nx.cast("double") * ny))


def log_rank(rank: Column) -> Column:
    """Natural log of a probability; zero maps to minus infinity, not to NULL."""
    return F.when(rank == 0, F.lit(float("-inf"))).otherwise(F.ln(rank))


def fixed_point(rank: Column, digits: int = 5) -> Column:
    """A rank as text with a fixed number of digits and no group separators."""
    return F.format_string(f"%.{digits}f", rank)
