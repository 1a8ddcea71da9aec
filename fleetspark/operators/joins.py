"""Joins against small derived lookups, with the broadcast decided on measured size.

A lookup such as "newest release per model" is bounded by models x versions, but
that bound is a property of the data. It is counted first (an aggregate that the
join needs anyway, reduced map-side) and broadcast only while it is small, so the
fact side is not shuffled; a larger lookup is joined by a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Rows up to which a lookup is broadcast.
LOOKUP_ROWS = 100_000


def join_lookup(fact: DataFrame, lookup: DataFrame, on, how: str = "left") -> DataFrame:
    """Left join of a derived lookup that leaves the fact side where it is while the lookup is small."""
    small = lookup.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    return fact.join(F.broadcast(lookup) if small else lookup, on=on, how=how)
