"""Bulk loading: JSON payloads and the gate on bad rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.chunks import chunk_rows

SUCCESS = "Success"


def load_payloads(
    df: DataFrame,
    db: str,
    table: str,
    columns: Sequence[str] | str,
    keys: Sequence[str],
    size: int,
    batch_id: str,
    max_bytes: int | None = None,
) -> DataFrame:
    """JSON array bodies of at most ``size`` rows, fields in target-table order.

    With ``max_bytes`` a body holds at most so many bytes as well; a longer row has a body of its own. Then a chunk of ``size`` rows is cut
    by its running length, and the label says which cut it is.

    The label depends on the batch and the chunk only, so sending a chunk again
    reuses it and loads nothing twice. A body holds at most ``size`` rows, so no
    group grows with the data. ``columns`` may be the name of the target in the catalog, whose columns are then
    taken. Only columns that the bodies or the order need are shuffled and written.
    """
    if isinstance(columns, str):
        columns = df.sparkSession.table(columns).columns
    needed = {*columns, *keys}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c in needed])
    have = set(df.columns)
    fields = [(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in columns]
    chunked = chunk_rows(df, size, *keys).select(
        "chunk_id", "position", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("_json")
    )
    cuts = []
    if max_bytes:
        # Rows that start in one half of the limit, and are no longer than it, fit into the whole; a comma or bracket goes with each.
        half = max(1, (max_bytes - 1) // 2)
        length = F.octet_length("_json") + 1
        before = F.coalesce(F.sum(length).over(Window.partitionBy("chunk_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        alone = F.when(length > half, F.col("position"))
        chunked = chunked.withColumns({"_half": F.floor(before / half), "_alone": alone})
        cuts = ["_half", "_alone"]
    bodies = chunked.groupBy("chunk_id", *cuts).agg(
        F.array_sort(F.collect_list(F.struct("position", "_json"))).alias("_rows")
    )
    joined = F.array_join(F.transform("_rows", lambda r: r["_json"]), ",")
    paths = "[" + ",".join(f'"$.{c}"' for c in columns) + "]"
    number = F.concat_ws("_", *[F.col(c).cast("string") for c in ("chunk_id", *cuts)])
    return bodies.select(
        F.concat(F.lit(f"{db}_{table}_{batch_id}_"), number).alias("label"),
        F.lit(paths).alias("jsonpaths"),
        F.size("_rows").alias("row_count"),
        F.concat(F.lit("["), joined, F.lit("]")).alias("body"),
    )


@dataclass
class Load:
    """Rows that fit the target, rows that do not, and the one-row result."""

    good: DataFrame
    rejects: DataFrame
    result: DataFrame
    accepted: bool

    def write(self, path: str, mode: str = "append", source: str = "parquet") -> None:
        if not self.accepted:
            raise ValueError("load refused: too many rows do not fit the target")
        self.good.write.mode(mode).format(source).save(path)


def is_success(status: str) -> bool:
    return status.lower() == SUCCESS.lower()


def strict_load(
    df: DataFrame, schema: str | T.StructType, max_filter_ratio: float = 0.0, where: str | None = None
) -> Load:
    """Casts to the target and accepts the load if few enough rows fail.

    ``where`` unselects rows, which then count neither as loaded nor as bad.
    One aggregate measures the load. The rows themselves are read again only if they are written.
    """
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    selected = F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True)
    casts = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in target.fields}
    lost = F.lit(False)
    for name, cast in casts.items():
        lost = lost | (F.col(f"`{name}`").isNotNull() & cast.isNull())
    required = [f.name for f in target.fields if not f.nullable]
    for name in required:
        lost = lost | F.col(f"`{name}`").isNull()
    flagged = df.withColumn("_selected", selected).withColumn("_bad", lost)
    counts = flagged.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("_selected") & ~F.col("_bad")).alias("loaded_rows"),
        F.count_if(F.col("_selected") & F.col("_bad")).alias("filtered_rows"),
        F.count_if(~F.col("_selected")).alias("unselected_rows"),
    ).first()
    considered = counts["loaded_rows"] + counts["filtered_rows"]
    accepted = counts["filtered_rows"] <= max_filter_ratio * considered
    result = df.sparkSession.createDataFrame(
        [(SUCCESS if accepted else "Fail", *counts)],
        "status string, total_rows bigint, loaded_rows bigint, filtered_rows bigint, unselected_rows bigint",
    )
    return Load(
        good=flagged.where("_selected and not _bad").select(*[c.alias(n) for n, c in casts.items()]),
        rejects=flagged.where("_selected and _bad").select(*df.columns),
        result=result,
        accepted=accepted,
    )
