"""Ordered name catalogues and lookups in both directions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The catalogues below must keep these names in this order,
# because the position of a name is its code.
PRIVILEGES = (
    "GRANT",
    "NODE",
    "CREATE RESOURCE GROUP",
    "CREATE RESOURCE",
    "CREATE EXTERNAL CATALOG",
    "PLUGIN",
    "REPOSITORY",
    "BLACKLIST",
    "FILE",
    "OPERATE",
    "CREATE GLOBAL FUNCTION",
    "CREATE STORAGE VOLUME",
    "USAGE",
    "ALL",
    "IMPERSONATE",
    "APPLY",
    "CREATE MASKING POLICY",
    "CREATE ROW ACCESS POLICY",
    "CREATE PIPE",
    "CREATE WAREHOUSE",
    "SECURITY",
    "CREATE DATABASE",
    "CREATE TABLE",
    "CREATE VIEW",
    "CREATE FUNCTION",
    "CREATE MATERIALIZED VIEW",
    "REFRESH",
    "SELECT",
    "ALTER",
    "INSERT",
    "CREATE",
    "DROP",
    "UPDATE",
    "DELETE",
)

GRANT_OBJECT_TYPES = (
    "SYSTEM",
    "WAREHOUSE",
    "RESOURCE GROUP",
    "RESOURCE",
    "USER",
    "GLOBAL FUNCTION",
    "FUNCTION",
    "CATALOG",
    "STORAGE VOLUME",
    "MASKING POLICY",
    "ROW ACCESS POLICY",
    "DATABASE",
    "TABLE",
    "MATERIALIZED VIEW",
    "VIEW",
)

ACTIONS = (
    "EXTRACT TIME",
    "WITH",
    "FROM",
    "JOIN",
    "SELECT",
    "ALTER",
    "INSERT",
    "CREATE",
    "DROP",
    "UPDATE",
    "DELETE",
    "TRUNCATE",
)

SERVICE_TYPES = ("hive", "hdfs", "cos", "yarn", "kms", "chdfs")

POLICY_OBJECT_TYPES = (
    "HIVE SERVICE",
    "URL",
    "GLOBAL UDF",
    "UDF",
    "DATABASE",
    "TABLE",
    "COLUMN",
    "MASKING",
    "ROW FILTER",
    "HDFS",
    "YARN",
    "COS",
    "CHDFS",
)


def names_array(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def name_index(name: Column, names: Sequence[str]) -> Column:
    """Position of the upper-cased name from 0, or -1 when it is unknown."""
    return code_of(F.upper(name), names)


def service_index(name: Column) -> Column:
    """Position of a service type; service names are kept in lower case."""
    return code_of(F.lower(name), SERVICE_TYPES)


def code_of(name: Column, names: Sequence[str]) -> Column:
    position = F.array_position(names_array(names), name)
    return (F.coalesce(position, F.lit(0)) - 1).cast("int")


def name_at(index: Column, names: Sequence[str], unknown: str = "nil") -> Column:
    """Name at a position, or ``unknown`` outside the catalogue."""
    inside = index.between(0, len(names) - 1)
    return F.when(inside, F.get(names_array(names), index)).otherwise(F.lit(unknown))
