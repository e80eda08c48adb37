"""Readers: databases, catalog tables, statements with arguments, listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import LISTING

# Connection defaults by database kind.
_JDBC = {
    "mysql": {
        "prefix": "jdbc:mysql", "port": 3306, "driver": "com.mysql.cj.jdbc.Driver",
        "options": "connectTimeout=10000&characterEncoding=utf8",
    },
    "postgres": {
        "prefix": "jdbc:postgresql", "port": 5432, "driver": "org.postgresql.Driver",
        "options": "sslmode=disable&connectTimeout=10",
    },
}


def jdbc_options(
    kind: str,
    host: str,
    database: str,
    query: str | None = None,
    table: str | None = None,
    port: int | None = None,
    user: str | None = None,
    password: str | None = None,
    query_timeout: int = 0,
    fetch_size: int = 10_000,
    connect_options: Sequence[str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> dict[str, str]:
    """Options for ``spark.read.format('jdbc')``.

    ``split`` = (column, lower, upper, partitions) reads a table or query in
    parallel; without it a single task reads everything.
    """
    if kind not in _JDBC:
        raise ValueError(f"unknown database kind: {kind}")
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    known = _JDBC[kind]
    extra = "&".join(connect_options) if connect_options else known["options"]
    options = {
        "url": f"{known['prefix']}://{host}:{port or known['port']}/{database}?{extra}",
        "driver": known["driver"],
        "queryTimeout": str(query_timeout),
        "fetchsize": str(fetch_size),
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if split is not None:
        column, lower, upper, partitions = split
        options["dbtable"] = table or f"({query}) AS source_rows"
        options.update(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    elif table is not None:
        options["dbtable"] = table
    else:
        options["query"] = query
    return options


def scan_jdbc(spark: SparkSession, kind: str, host: str, database: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(kind, host, database, **options)).load()


def scan_hive(spark: SparkSession, query: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Query over catalog tables; on a cluster the session's catalog is the Hive one.

    ``settings`` hold while the statement is analysed; then the session has its own values back.
    """
    before = {key: spark.conf.get(key, None) for key in settings or {}}
    try:
        for key, value in (settings or {}).items():
            spark.conf.set(key, value)
        return spark.sql(query)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scan_bound(spark: SparkSession, query: str, *args) -> DataFrame:
    """Query with positional arguments in place of ``?``."""
    return spark.sql(query, args=list(args))


def exec_statement(spark: SparkSession, statement: str) -> None:
    """Statement run for its effect."""
    spark.sql(statement)


def as_text(df: DataFrame, null_text: str = "") -> DataFrame:
    """Every value as text."""
    return df.select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(null_text)).alias(c) for c in df.columns]
    )


def as_typed(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Columns of the schema, by name and cast; a column the rows do not have is NULL.

    A value that does not fit stops the job, as a failed conversion should.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields
    ])


def scan_inventory(spark: SparkSession, path: str, source: str = "parquet", **options) -> DataFrame:
    """Object listing from files, with its fixed schema: nothing is inferred."""
    return spark.read.schema(LISTING).options(**options).format(source).load(path)
