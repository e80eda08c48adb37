"""Map functions and aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind


def map_invert(m: Column) -> Column:
    """Swap keys and values; of several keys with one value the greatest wins.

    Sorting (value, key) pairs puts the winner last among equal values, so one
    look at the next pair decides. Spark raises on duplicate map keys otherwise.
    """
    pairs = F.array_sort(
        F.transform(F.map_entries(m), lambda e: F.struct(e["value"].alias("k"), e["key"].alias("v")))
    )
    return bind(
        pairs,
        lambda s: F.map_from_entries(
            F.filter(s, lambda e, i: ~F.coalesce(F.get(s, i + 1)["k"] == e["k"], F.lit(False)))
        ),
    )


def widest_map(m: Column, order: Column) -> Column:
    """Aggregate: the map with most keys; the lowest ``order`` wins a tie."""
    return F.max_by(m, F.struct(F.size(m), -order))
