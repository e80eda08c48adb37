"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import cut
from .tables import join_on

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """For every node of directed edges the least of itself and its targets."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``u, low``: each node of the links ``u, v`` and the least node of its component.

    Every step gives each node's larger (or smaller) neighbours the least neighbour; the
    edges become stars. They are written to the shared folder after each round, and only
    two sums come to the driver.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut(edges)
    state = None
    for _ in range(MAX_ROUNDS):
        around = _both(edges)
        large = join_on(around, _least(around), ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        lows = _least(large)
        small = join_on(large, lows, ["u"]).where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = cut(small.unionByName(lows.select("u", F.col("low").alias("v"))).where("u <> v").distinct())
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sums) == state:
            return edges.select("u", F.col("v").alias("low")).unionByName(
                edges.select(F.col("v").alias("u"), F.col("v").alias("low")).distinct()
            )
        state = tuple(sums)
    raise RuntimeError("components did not settle")
