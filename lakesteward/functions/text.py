"""Text helpers shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode property White_Space.
WHITE_SPACE = "".join(map(chr, [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def trim_ws(c: Column) -> Column:
    """Strip every kind of Unicode blank; plain ``trim`` only strips spaces."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def or_empty(c: Column) -> Column:
    """Text with NULL read as the empty string."""
    return F.coalesce(c, F.lit(""))


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda re-evaluates everything it captures for each element. Passing the
    value through a one-element array turns it into a lambda variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
