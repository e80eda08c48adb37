"""Sinks: reports of several named sheets, and text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def sheet_names(count: int, names: Sequence[str] | None = None) -> list[str]:
    """The given names, or the fixed default name of each page."""
    if names:
        if len(names) < count:
            raise ValueError("fewer sheet names than sheets")
        return list(names[:count])
    return [f"第{i}页" for i in range(1, count + 1)]


def report_sink(
    path: str,
    sheets: Sequence[DataFrame],
    names: Sequence[str] | None = None,
    titles: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> list[str]:
    """Writes every sheet as its own CSV dataset with a header; returns their paths.

    Each sheet is written by all tasks in parallel, one header per file.
    """
    if not sheets:
        raise ValueError("no data to report")
    paths = []
    for sheet, name in zip(sheets, sheet_names(len(sheets), names)):
        titled = sheet.toDF(*titles) if titles else sheet
        target = f"{path.rstrip('/')}/{name}"
        titled.write.mode(mode).option("header", True).option("escape", '"').csv(target)
        paths.append(target)
    return paths


def text_sink(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Writes the ``value`` column as text lines."""
    df.select("value").write.mode(mode).text(path)
    return path
