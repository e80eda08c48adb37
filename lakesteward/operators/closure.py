"""Reachability in a link table, and what it means for grants: the privileges a grantee has through roles of roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import scratch_path
from .grants import grant_flat
from .joins import KEY_ROWS, spread_join


def transitive_closure(links: DataFrame) -> DataFrame:
    """``source, target`` of all pairs that one or more links ``source, target`` join; cycles end, a node on one reaches itself.

    Semi-naive: each round follows the links from the pairs of the round before only, and keeps those that are
    new. Every round is written and read back, so the plan and the driver's work stay the same from round to round. Links with a null end are ignored.
    """
    spark = links.sparkSession
    root = scratch_path(spark, "closure")
    given = links.select("source", "target").where("source is not null and target is not null").distinct()
    given.write.parquet(f"{root}/0")
    schema = given.schema
    step = spark.read.schema(schema).parquet(f"{root}/0")
    edges = step.select(F.col("source").alias("target"), F.col("target").alias("next"))
    paths = [f"{root}/0"]
    while True:
        found = step.join(edges, "target").select("source", F.col("next").alias("target")).distinct()
        known = spark.read.schema(schema).parquet(*paths)
        path = f"{root}/{len(paths)}"
        found.join(known, ["source", "target"], "left_anti").write.parquet(path)
        step = spark.read.schema(schema).parquet(path)
        if step.isEmpty():
            return known
        paths.append(path)


def _written(df: DataFrame, path: str) -> DataFrame:
    """The rows as files, for what is read more than once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def effective_grants(grants: DataFrame, key_rows: int = KEY_ROWS) -> DataFrame:
    """``grantee_type, grantee_name, ip, object_type, object_name, object_db_name, object_tbl_name, permission``: all that each grantee may do,
    by grants of its own and by those of the roles it has, directly or through other roles; distinct.

    The closure is taken over roles alone, which are few beside users; users meet it once. A role that nearly all have fills no task: its
    holders are dealt, ``key_rows`` at a time.
    """
    root = scratch_path(grants.sparkSession, "grants")
    flat = grant_flat(grants)
    holder = F.struct("grantee_type", "grantee_name", "ip")
    given = flat.where("object_type = 'ROLE'").select(holder.alias("holder"), F.explode("permissions").alias("role"))
    given = _written(given.distinct(), f"{root}/given")
    between = given.where("holder.grantee_type = 'ROLE'").select(F.col("holder.grantee_name").alias("source"), F.col("role").alias("target"))
    reach = transitive_closure(between)
    roles = given.select("holder", F.col("role").alias("target")).unionByName(
        given.join(reach, given["role"] == reach["source"]).select("holder", "target")
    )
    roles = _written(roles.distinct(), f"{root}/roles")
    objects = ["object_type", "object_name", "object_db_name", "object_tbl_name"]
    rights = flat.where("object_type <> 'ROLE'").select(holder.alias("holder"), *objects, F.explode("permissions").alias("permission"))
    rights = _written(rights.distinct(), f"{root}/rights")
    of_roles = rights.where("holder.grantee_type = 'ROLE'").select(F.col("holder.grantee_name").alias("target"), *objects, "permission")
    inherited = spread_join(roles, of_roles, ["target"], key_rows).select("holder", *objects, "permission")
    return inherited.unionByName(rights).distinct().select("holder.*", *objects, "permission")
