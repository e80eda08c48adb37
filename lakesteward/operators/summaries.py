"""Summaries of listings and usage: nested path rollups, the most used per group, and differences of snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .inventory import inventory_full

LEVELS = 6
# Registers of the distinct-count sketch are 2^SKETCH_BITS: a standard error of about 1.04 / sqrt(2^SKETCH_BITS), 1.6 %.
SKETCH_BITS = 12
# Parts in which a group's candidates are ranked before the last ranking.
RANK_PARTS = 64


# --- nested rollup -----------------------------------------------------------

def path_rollup(listing: DataFrame) -> DataFrame:
    """``path_level, path, objects, total_size, owners``: what lies at and below every folder of the levels.

    Objects are added up by their whole chain of levels first, with a sketch of their owners; only these sums, one per chain, are then
    spread to the folders above and merged. So the listing is read and shuffled once, combined before the shuffle, and no row of it is copied
    per level. ``owners`` is the sketch's estimate of the number of different owners.
    """
    chain = [f"extend_level{k}_name" for k in range(1, LEVELS + 1)]
    summed = inventory_full(listing).groupBy(*chain).agg(
        F.count("*").alias("objects"), F.sum("size").alias("total_size"), F.hll_sketch_agg("user", SKETCH_BITS).alias("sketch"),
    )
    # A folder of every level down to the first blank one.
    open_ = F.lit(True)
    folders = [F.struct(F.lit(0).alias("path_level"), F.lit("/").alias("path"))]
    for k in range(1, LEVELS + 1):
        open_ = open_ & (F.col(chain[k - 1]) != "")
        path = F.concat(F.lit("/"), F.concat_ws("/", *chain[:k]))
        folders.append(F.when(open_, F.struct(F.lit(k).alias("path_level"), path.alias("path"))))
    spread = summed.withColumn("folder", F.explode(F.array_compact(F.array(*folders))))
    merged = spread.groupBy("folder.path_level", "folder.path").agg(
        F.sum("objects").alias("objects"), F.sum("total_size").alias("total_size"), F.hll_union_agg("sketch").alias("sketch"),
    )
    return merged.select("path_level", "path", "objects", "total_size", F.hll_sketch_estimate("sketch").alias("owners"))


# --- top k -------------------------------------------------------------------

def top_per_group(counted: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, parts: int = RANK_PARTS) -> DataFrame:
    """The first ``k`` rows of each group by ``order``, with their ``rank`` from 1. ``order`` must leave no ties.

    Every part of a group keeps its own first k before anything of the group meets, so the last ranking sees
    ``parts * k`` rows of a group at most, whatever its size.
    """
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in counted.columns]), F.lit(parts))
    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    first = counted.withColumn("_part", part).withColumn("_rank", F.row_number().over(inside)).where(F.col("_rank") <= k)
    whole = Window.partitionBy(*group).orderBy(*order)
    ranked = first.drop("_part", "_rank").withColumn("rank", F.row_number().over(whole))
    return ranked.where(F.col("rank") <= k)


def usage_top(usage: DataFrame, k: int) -> DataFrame:
    """``catalog, action, db_name, table_name, uses, rank``: the k most used tables of each catalogue and action, ties by name."""
    names = ["catalog", "action", "db_name", "table_name"]
    counted = usage.groupBy(*names).agg(F.count("*").alias("uses"))
    return top_per_group(counted, ["catalog", "action"], [F.col("uses").desc(), F.col("db_name").asc(), F.col("table_name").asc()], k)


# --- difference --------------------------------------------------------------

def snapshot_difference(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """The columns of both, ``copies`` and ``status``: rows that one snapshot has more often than the other, as multisets.

    ``copies`` says how many more times the later snapshot has the row; it is below 0 for rows that went. Rows that came or went are ``added`` or
    ``removed``, and ``changed`` if the other snapshot has other rows of the same key instead. Both snapshots are counted together in one shuffle,
    combined before it; only the differences are looked at again by key. Null columns equal each other.
    """
    columns = before.columns
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    counted = signed.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.sum("_sign").alias("copies")).where("copies <> 0")
    by_key = counted.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.min("copies").alias("_least"), F.max("copies").alias("_most"))
    both = by_key.where("_least < 0 and _most > 0").select("_key", F.lit(True).alias("_both"))
    judged = counted.join(both, F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left")
    status = F.when(F.col("_both"), "changed").when(F.col("copies") > 0, "added").otherwise("removed")
    return judged.select(*[F.col(f"`{c}`") for c in columns], "copies", status.alias("status"))
