"""Reading the given tables and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import scratch_path

# The characters that separate words, as the inside of a regular expression class.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back.

    Unlike a checkpoint it carries no partitioning and order of its joins along, which chains of self-joins would
    double at every step.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(text, F.lit(""))


def word_count(text: Column | str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{BLANKS}]+")).cast("long")


def fingerprint(text: Column | str) -> Column:
    """16 bytes that stand for a whole text; null counts as the empty text."""
    return F.unhex(F.md5(text_or_empty(text)))


def free_name(df: DataFrame, wanted: str) -> str:
    """The wanted column name, lengthened until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def join_on(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", null_keys: tuple[str, ...] = ()
) -> DataFrame:
    """Join on equally named keys: the left columns, then the right ones that are no keys.

    ``null_keys`` are the keys whose nulls meet each other.
    """
    renamed = right.toDF(*[f"_right_{c}" for c in right.columns])
    met = F.lit(True)
    for key in keys:
        other = F.col(f"_right_{key}")
        met = met & (F.col(key).eqNullSafe(other) if key in null_keys else F.col(key) == other)
    joined = left.join(renamed, met, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select(*left.columns, *[F.col(f"_right_{c}").alias(c) for c in right.columns if c not in keys])
