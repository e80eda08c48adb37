"""A sink for labelled payloads that loads every label once, however often tasks or whole loads are repeated.

Tasks write bodies to files with names of their own attempt and report them in their commit messages. The driver commits a load by one
ledger file that lists what the messages report; files of lost or repeated attempts are in no ledger. Labels that the ledger holds are
left out before a load is written, and if two loads of a label commit at once, the entry of the least commit name counts. So a label
has one body whatever happened.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "labelled_load"
LEDGER = "label string, file string, first long, length long, row_count long, sha256 string, commit string"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote."""

    entries: list[dict] = field(default_factory=list)


class LabelledWriter(DataSourceArrowWriter):
    """Writes ``label, row_count, body`` rows: a file for each task, a ledger file for the load."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        name, entries, out, at = f"{uuid.uuid4().hex}.bodies", [], None, 0
        store, root = _opened(f"{self.path}/bodies")
        try:
            for batch in iterator:
                for row in batch.select(["label", "row_count", "body"]).to_pylist():
                    if out is None:
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}")
                    data = row["body"].encode()
                    out.write(data)
                    entries.append({
                        "label": row["label"], "file": name, "first": at, "length": len(data), "row_count": row["row_count"],
                        "sha256": hashlib.sha256(data).hexdigest(),
                    })
                    at += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(entries)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """One ledger file, which is there as a whole or not at all."""
        entries = [e for m in messages if m is not None for e in m.entries]
        if not entries:
            return
        commit = uuid.uuid4().hex
        store, root = _opened(f"{self.path}/ledger")
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/_{commit}") as out:
            for entry in entries:
                out.write((json.dumps({**entry, "commit": commit}) + "\n").encode())
        store.move(f"{root}/_{commit}", f"{root}/{commit}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Files of a load that failed are in no ledger; those that are known go."""
        store, root = _opened(f"{self.path}/bodies")
        for name in {e["file"] for m in messages if m is not None for e in m.entries}:
            store.delete_file(f"{root}/{name}")


class LabelledLoad(DataSource):
    """The data source behind ``load_once``; write only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "label string, row_count long, body string"

    def writer(self, schema, overwrite: bool) -> LabelledWriter:
        if overwrite:
            raise ValueError("a ledger is only added to")
        return LabelledWriter(self.options["path"])


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The entry that counts of every loaded label."""
    store, root = _opened(f"{path}/ledger")
    if store.get_file_info(root).type == fs.FileType.NotFound:
        return spark.createDataFrame([], LEDGER)
    entries = spark.read.schema(LEDGER).json(f"{path}/ledger/*.json")
    columns = [c for c in entries.columns if c != "label"]
    return entries.groupBy("label").agg(F.min(F.struct("commit", *[c for c in columns if c != "commit"])).alias("e")).select("label", "e.*")


def load_once(payloads: DataFrame, path: str) -> None:
    """Loads the payloads (``label, row_count, body``) whose labels are not loaded yet; of several with one label in a load one counts."""
    spark = payloads.sparkSession
    spark.dataSource.register(LabelledLoad)
    new = payloads.join(ledger(spark, path).select("label"), "label", "left_anti")
    new.select("label", F.col("row_count").cast("long").alias("row_count"), "body").write.format(FORMAT).option("path", path).mode("append").save()


def loaded_bodies(spark: SparkSession, path: str) -> DataFrame:
    """``label, row_count, body`` of every loaded label. A body that is not what was written fails the read."""
    found = ledger(spark, path).select("label", "row_count", "file", "first", "length", "sha256")
    root_path = f"{path}/bodies"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(root_path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as file:
                    file.seek(row["first"])
                    data = file.read(row["length"])
                if hashlib.sha256(data).hexdigest() != row["sha256"]:
                    raise ValueError(f"the body of {row['label']} is damaged")
                yield pa.RecordBatch.from_pydict({
                    "label": pa.array([row["label"]]), "row_count": pa.array([row["row_count"]], pa.int64()), "body": pa.array([data.decode()]),
                })

    return found.mapInArrow(read, "label string, row_count long, body string")
