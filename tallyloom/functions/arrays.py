"""Column expressions over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """``value`` as a column that later expressions refer to instead of repeating it.

    The optimizer copies a computed column into the filters it pushes down and
    into lambdas, which would tokenize or sort again, in a lambda even once per
    element. It does not copy over a generator, here one of a single row.
    """
    return F.explode(F.array(value))
