"""List functions over array<string> columns. None of them needs a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, trim_ws


def list_intersect(a: Column, b: Column) -> Column:
    """Distinct common elements, sorted."""
    return F.array_sort(F.array_intersect(a, b))


def list_contains(a: Column, value) -> Column:
    return F.array_contains(a, value)


def list_index(a: Column, value) -> Column:
    """First position from 0, or -1."""
    return (F.array_position(a, value) - 1).cast("int")


def list_minus(a: Column, b: Column) -> Column:
    """Elements of ``a`` that are not in ``b``; order and duplicates are kept.

    ``array_except`` would drop duplicates. The hash-based intersection finds what
    the lists share; those elements go into buckets by hash, so that each element
    of ``a`` is compared with one small bucket instead of all of them.
    """
    def bucket_of(x: Column, count: Column) -> Column:
        return F.pmod(F.hash(x), count).cast("int")

    def bucketed(common: Column) -> Column:
        count = F.ceil(F.sqrt(F.size(common))).cast("int") + 1
        tagged = F.transform(common, lambda x: F.struct(bucket_of(x, count).alias("at"), x.alias("x")))
        return bind(tagged, lambda t: F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda k: F.transform(F.filter(t, lambda e: e["at"] == k), lambda e: e["x"]),
        ))

    buckets = bind(F.array_intersect(a, b), bucketed)
    return bind(
        F.struct(a.alias("a"), buckets.alias("buckets")),
        lambda s: F.filter(
            s["a"],
            lambda x: ~F.array_contains(F.get(s["buckets"], bucket_of(x, F.size(s["buckets"]))), x),
        ),
    )


def list_match_any(value: Column, parts: Column | Sequence[str]) -> Column:
    """Does the text hold any of the substrings?"""
    if isinstance(parts, Column):
        return F.exists(parts, lambda p: F.contains(value, p))
    hit = F.lit(False)
    for p in parts:
        hit = hit | F.contains(value, F.lit(p))
    return hit


def list_drop_matching(a: Column, parts: Column | Sequence[str]) -> Column:
    """Elements that hold none of the substrings."""
    return F.filter(a, lambda x: ~list_match_any(x, parts))


def list_distinct(a: Column) -> Column:
    """Trimmed distinct elements, in order of first occurrence."""
    return F.array_distinct(F.transform(a, trim_ws))


def list_distinct_lower(a: Column) -> Column:
    return F.array_distinct(F.transform(a, lambda x: F.lower(trim_ws(x))))


def list_chunks(a: Column, size: int) -> Column:
    """Contiguous slices of ``size`` elements and a short tail; none for an empty list."""
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    count = F.ceil(F.size(a) / F.lit(size)).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(a, i * size + 1, F.lit(size)))
