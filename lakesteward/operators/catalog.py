"""Column catalogues: statements built from them, and names taken from field tags.

A catalogue is a table with one row per column: ``table_name, pos, column_name,
type`` for statements; ``pos, field_name, field_type, tags`` for tags.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_empty

# Names used when a statement has no target, and the extra padding.
DEFAULT_DB = "default_db"
DEFAULT_TABLE = "default_tbl"
PADDING = 10


def _quoted(name: Column) -> Column:
    return F.concat(F.lit("`"), name, F.lit("`"))


def _create_line(name: Column, kind: Column, name_width: Column, type_width: Column) -> Column:
    return F.concat(
        F.lit("    "), F.rpad(_quoted(name), name_width + PADDING, F.lit(" ")),
        F.lit("    "), F.rpad(kind, type_width + PADDING, F.lit(" ")),
    )


def _frame(kind: str, db: Column, table: Column) -> tuple[Column, Column]:
    target = F.concat(db, F.lit("."), table)
    if kind == "create":
        return F.concat(F.lit("create table "), target, F.lit(" (")), F.lit(")")
    if kind == "select":
        return F.lit("select"), F.concat(F.lit("from "), target)
    raise ValueError(f"unknown statement kind: {kind}")


def ddl_statements(catalogue: DataFrame, kind: str, db: str = DEFAULT_DB) -> DataFrame:
    """One ``create`` or ``select`` statement per table, columns in ``pos`` order.

    A statement is one text value, so a table's columns meet in one row. For
    catalogues with tables too wide for that, use ``ddl_lines``.
    """
    column = F.struct("pos", "column_name", or_empty(F.col("type")).alias("type"))
    tables = catalogue.groupBy("table_name").agg(
        F.array_sort(F.collect_list(column)).alias("columns"),
        F.max(F.octet_length("column_name")).alias("name_width"),
        F.max(F.octet_length(or_empty(F.col("type")))).alias("type_width"),
    )
    head, tail = _frame(kind, F.lit(db), _target("table_name"))

    def line(c: Column) -> Column:
        if kind == "select":
            return _quoted(c["column_name"])
        return _create_line(c["column_name"], c["type"], F.col("name_width"), F.col("type_width"))

    body = F.array_join(F.transform("columns", line), ",\n")
    return tables.select("table_name", F.concat_ws("\n", head, body, tail).alias("statement"))


def _target(column: str) -> Column:
    name = or_empty(F.col(column))
    return F.when(name == "", F.lit(DEFAULT_TABLE)).otherwise(name)


def ddl_lines(catalogue: DataFrame, kind: str, db: str = DEFAULT_DB) -> DataFrame:
    """The same statements as numbered lines, for catalogues with very wide tables.

    No group is collected: the widths are a partial aggregate joined back to the columns.
    """
    widths = catalogue.groupBy("table_name").agg(
        F.max(F.octet_length("column_name")).alias("name_width"),
        F.max(F.octet_length(or_empty(F.col("type")))).alias("type_width"),
        F.max("pos").alias("last_pos"),
    )
    head, tail = _frame(kind, F.lit(db), _target("table_name"))
    joined = catalogue.join(widths, "table_name")
    if kind == "select":
        text = _quoted(F.col("column_name"))
    else:
        text = _create_line(F.col("column_name"), or_empty(F.col("type")), F.col("name_width"), F.col("type_width"))
    comma = F.when(F.col("pos") < F.col("last_pos"), ",").otherwise("")
    body = joined.select("table_name", F.lit(1).alias("section"), "pos", F.concat(text, comma).alias("line"))
    edges = widths.select(
        "table_name",
        F.inline(F.array(
            F.struct(F.lit(0).alias("section"), F.lit(None).cast("int").alias("pos"), head.alias("line")),
            F.struct(F.lit(2).alias("section"), F.lit(None).cast("int").alias("pos"), tail.alias("line")),
        )),
    )
    return body.unionByName(edges)


# --- names from tags ---------------------------------------------------------

def field_catalogue(df: DataFrame) -> DataFrame:
    """Fields of a table as a tag catalogue; tags are the text entries of the field metadata."""
    rows = [
        (i, f.name, f.dataType.simpleString(), {k: v for k, v in f.metadata.items() if isinstance(v, str)})
        for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "pos int, field_name string, field_type string, tags map<string,string>"
    )


def schema_names(fields: DataFrame, tag: str, with_type: bool, split_key: str | None = None) -> DataFrame:
    """(column name, type) or (field name, column name) by one tag set.

    With a split key, a tag is a comma list and the entries that start with the
    key hold the name.
    """
    value = or_empty(F.try_element_at("tags", F.lit(tag)))
    if split_key is None:
        named = fields.withColumn("column_name", value)
    else:
        entries = F.filter(F.split(value, ","), lambda e: F.startswith(e, F.lit(split_key)))
        named = fields.withColumn("_entry", F.explode(entries)).withColumn(
            "column_name", F.substr("_entry", F.lit(len(split_key) + 1))
        )
    if with_type:
        return named.select("column_name", F.col("field_type").alias("type"))
    return named.select("field_name", "column_name")


def _tag_name(metadata: Mapping, tag: str, split_key: str | None) -> str:
    value = str(metadata.get(tag, ""))
    if split_key is None:
        return value
    names = [e[len(split_key):] for e in value.split(",") if e.startswith(split_key)]
    return names[-1] if names else ""


def tag_mapping(
    df: DataFrame, from_tag: str, to_tag: str, from_key: str | None = None, to_key: str | None = None
) -> dict[str, str]:
    """Names of one tag set -> names of another, from the field metadata of a table."""
    pairs = [
        (_tag_name(f.metadata, from_tag, from_key), _tag_name(f.metadata, to_tag, to_key))
        for f in df.schema.fields
    ]
    return dict(pairs)


def schema_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; empty names on either side are skipped."""
    return df.withColumnsRenamed({a: b for a, b in mapping.items() if a and b})
