"""Tables whose rows are maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import widest_map


def map_widest(df: DataFrame, column: str, order: str) -> DataFrame:
    """One row with the map that has most keys (lowest ``order`` on ties); NULL for no rows.

    A partial and final aggregate: each task passes on one map.
    """
    return df.agg(widest_map(F.col(column), F.col(order)).alias(column))


def map_to_table(df: DataFrame, column: str, order: str, titles: Sequence[str] | None = None) -> DataFrame:
    """Map rows -> columns named by the widest map, sorted, or by the given titles.

    Only the key names of one map reach the driver. A key missing in a row gives NULL.
    """
    if titles is None:
        widest = map_widest(df, column, order).select(F.map_keys(column).alias("keys")).first()
        titles = sorted(widest["keys"] or [])
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, *[F.try_element_at(F.col(column), F.lit(t)).alias(t) for t in titles])


def map_max_lengths(df: DataFrame, column: str) -> DataFrame:
    """Longest key and longest value in bytes, 0 for no rows. No explode is needed."""
    def longest(texts):
        return F.coalesce(F.max(F.array_max(F.transform(texts, F.octet_length))), F.lit(0))

    return df.agg(
        longest(F.map_keys(column)).alias("max_key_length"),
        longest(F.map_values(column)).alias("max_value_length"),
    )
