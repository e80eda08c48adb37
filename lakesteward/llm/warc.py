"""Pages as WARC files, and a Merkle fixity audit of their replicas.

``write_warc`` writes each partition of pages into files of its own, one gzip member for each record, and
returns the catalogue: file, place in the file, offset and length of every record. ``leaf_hashes`` reads the catalogued
byte ranges from a replica and hashes them. ``merkle_levels`` hashes the ordered offset ranges of a file into a tree,
FAN children a node, and ``replica_levels`` the files' roots into a tree by the digits of a hash of their names, up to one root for the replica.
``audit`` compares the two replicas' roots first, which ends it if they agree, and goes
down only below nodes that differ, so equal parts of two replicas are never compared record by record.

Defined results: a null page is an empty payload, a null url an empty target; repeated rows are separate records; a
range that a replica lacks, or a file that is missing, has the status missing, other differences corrupt; an empty table
writes no file and gives an empty audit; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import join_on
from .tokens import _open

FILE_BYTES = 64 << 20
FAN = 16
# Fixed date, so that writing twice gives the same bytes.
DATE = "2024-01-01T00:00:00Z"
CATALOGUE = "page_id {id}, file string, place long, first long, length long"


def record_bytes(page_id, url: str | None, page: str | None) -> bytes:
    """One WARC resource record as a gzip member."""
    body = (page or "").encode("utf-8", "surrogatepass")
    target = "".join(c for c in url or "" if c > " ")
    head = (
        "WARC/1.1\r\nWARC-Type: resource\r\n"
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {target}')}>\r\n"
        f"WARC-Date: {DATE}\r\nWARC-Target-URI: {target}\r\nWARC-Block-Digest: sha256:{hashlib.sha256(body).hexdigest()}\r\n"
        f"Content-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
    )
    return gzip.compress(head.encode() + body + b"\r\n\r\n", 6, mtime=0)


def _rows(ids, file: str, rows: list[tuple[int, int, int]], at: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([file] * len(rows)), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]],
        names=["page_id", "file", "place", "first", "length"],
    )


def write_warc(pages: DataFrame, path: str) -> DataFrame:
    """Writes the files under ``path/files`` and returns the catalogue, kept under ``path/catalogue``."""
    spark = pages.sparkSession
    schema = CATALOGUE.format(id=pages.schema["page_id"].dataType.simpleString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(f"{path}/files")
        store.create_dir(root, recursive=True)
        out, name, place, first = None, "", 0, 0
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows, start = [], 0
                for i, (page_id, url, page) in enumerate(zip(*(c.to_pylist() for c in part.columns))):
                    if out is None or first >= FILE_BYTES:
                        if rows:
                            yield _rows(part.column(0).slice(start, len(rows)), name, rows, place)
                            rows, start = [], i
                        if out:
                            out.close()
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out, place, first = store.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                    record = record_bytes(page_id, url, page)
                    out.write(record)
                    rows.append((place, first, len(record)))
                    place, first = place + 1, first + len(record)
                if rows:
                    yield _rows(part.column(0).slice(start, len(rows)), name, rows, place)
        if out:
            out.close()

    # Only the catalogue's rows are committed: a file of a lost task is in none of them.
    pages.select("page_id", "url", "html").mapInArrow(write, schema).write.parquet(f"{path}/catalogue")
    return spark.read.schema(schema).parquet(f"{path}/catalogue")


def _by_file(catalogue: DataFrame) -> DataFrame:
    files = max(1, catalogue.select("file").distinct().count())
    return catalogue.repartition(files, "file").sortWithinPartitions("file", "first")


def copy_replica(catalogue: DataFrame, source: str, target: str, damage: Callable | None = None, column: str | None = None) -> int:
    """Copies the catalogued records of ``source/files`` to ``target/files`` and returns their number.

    ``damage`` gets the bytes of each record whose ``column`` is true; it returns as many, or None to end the file there.
    """
    marks = F.col(column) if column else F.lit(False)
    rows = _by_file(catalogue.select("file", "place", "first", "length", marks.alias("mark")))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, root), (to_store, to_root) = _open(f"{source}/files"), _open(f"{target}/files")
        to_store.create_dir(to_root, recursive=True)
        name, into, out, copied, ended = None, None, None, 0, False
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != name:
                    for file in (into, out):
                        if file:
                            file.close()
                    name, ended = row["file"], False
                    into = store.open_input_file(f"{root}/{name}")
                    # The last of several attempts to write a file wins; all write the same bytes.
                    out = to_store.open_output_stream(f"{to_root}/{name}", compression=None)
                if ended:
                    continue
                into.seek(row["first"])
                data = into.read(row["length"])
                if row["mark"] and damage:
                    data = damage(data)
                    ended = data is None
                if not ended:
                    out.write(data)
                    copied += 1
        for file in (into, out):
            if file:
                file.close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([copied], pa.int64())})

    return rows.mapInArrow(copy, "n long").agg(F.sum("n")).first()[0] or 0


def leaf_hashes(catalogue: DataFrame, path: str, ranges: bool = False) -> DataFrame:
    """``file, node, hash`` of every catalogued record as a replica has it, with ``first, length`` if asked; hash is null where the range is missing."""
    rows = _by_file(catalogue.select("file", "place", "first", "length"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(f"{path}/files")
        name, file = None, None
        for batch in batches:
            hashes = []
            for row in batch.to_pylist():
                if row["file"] != name:
                    if file:
                        file.close()
                    name = row["file"]
                    try:
                        file = store.open_input_file(f"{root}/{name}")
                    except FileNotFoundError:
                        file = None
                data = b""
                if file and row["first"] + row["length"] <= file.size():
                    file.seek(row["first"])
                    data = file.read(row["length"])
                hashes.append(hashlib.sha256(data).digest() if len(data) == row["length"] else None)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(4)], pa.array(hashes, pa.binary())], names=["file", "node", "first", "length", "hash"]
            )
        if file:
            file.close()

    leaves = rows.mapInArrow(read, "file string, node long, first long, length long, hash binary")
    return leaves if ranges else leaves.select("file", "node", "hash")


def _digest(order: str, *parts) -> Column:
    """Hash over the rows of a group, ordered by one of the parts."""
    part = F.concat_ws(":", *parts)
    rows = F.array_sort(F.collect_list(F.struct(order, part.alias("part"))))
    return F.unhex(F.sha2(F.array_join(F.transform(rows, lambda c: c["part"]), ","), 256))


def _parents(level: DataFrame) -> DataFrame:
    """The next level: each node hashes its children's numbers, offset ranges and hashes in order; FAN of them at most."""
    digest = _digest("node", F.col("node"), F.col("first"), F.col("length"), F.coalesce(F.hex("hash"), F.lit("missing")))
    end = F.max(F.col("first") + F.col("length"))
    grouped = level.groupBy("file", F.floor(F.col("node") / FAN).alias("parent")).agg(
        F.min("first").alias("first"), (end - F.min("first")).alias("length"), digest.alias("hash")
    )
    return grouped.select("file", F.col("parent").cast("long").alias("node"), "first", "length", "hash")


def merkle_levels(leaves: DataFrame) -> list[DataFrame]:
    """All levels of the files' trees, leaves first; the last one has one node a file. Leaves without offset ranges are placed by their numbers."""
    depth, most = 0, leaves.agg(F.max("node")).first()[0] or 0
    if "first" not in leaves.columns:
        leaves = leaves.select("file", "node", F.col("node").alias("first"), F.lit(1).cast("long").alias("length"), "hash")
    levels = [leaves]
    while most >= FAN ** depth or not depth:
        levels.append(_parents(levels[-1]))
        depth += 1
    return levels


def _file_key(digits: int) -> Column:
    return F.substring(F.sha2("file", 256), 1, digits)


def replica_levels(levels: list[DataFrame]) -> list[DataFrame]:
    """``key, hash`` of the tree over the files' roots, from the deepest level to the replica's root, whose key is empty."""
    roots = levels[-1].select("file", "hash")
    files = roots.count()
    digits = 0
    while 16 ** (digits + 1) <= files:
        digits += 1
    tops = [roots.groupBy(_file_key(digits).alias("key")).agg(_digest("file", F.col("file"), F.hex("hash")).alias("hash"))]
    for short in range(digits - 1, -1, -1):
        parent = F.substring("key", 1, short).alias("parent")
        grouped = tops[-1].groupBy(parent).agg(_digest("key", F.col("key"), F.hex("hash")).alias("hash"))
        tops.append(grouped.withColumnRenamed("parent", "key"))
    return tops


def replica_root(levels: list[DataFrame]) -> DataFrame:
    """One row with the replica's root; none for a replica without files."""
    return replica_levels(levels)[-1].select("hash")


def audit(left: list[DataFrame], right: list[DataFrame]) -> DataFrame:
    """``file, node, status`` of every record that differs between two replicas with the same catalogue."""
    ours_top, theirs_top = replica_levels(left), replica_levels(right)
    if ours_top[-1].first() == theirs_top[-1].first():
        return left[0].limit(0).select("file", "node", F.lit("").alias("status"))
    keys = None
    for ours, theirs in zip(reversed(ours_top), reversed(theirs_top)):
        if keys is not None:
            above = keys.withColumnRenamed("key", "parent")
            ours = join_on(ours.withColumn("parent", F.expr("substring(key, 1, length(key) - 1)")), above, ["parent"], "left_semi").drop("parent")
        both = join_on(ours, theirs.withColumnRenamed("hash", "other"), ["key"])
        keys = both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("key")
    digits = len(ours_top) - 1
    suspects = None
    for ours, theirs in zip(reversed(left), reversed(right)):
        ours = ours.select("file", "node", "hash")
        if suspects is None:
            ours = join_on(ours.withColumn("key", _file_key(digits)), keys, ["key"], "left_semi").drop("key")
        else:
            parents = suspects.select("file", F.col("node").alias("parent"))
            ours = join_on(ours.withColumn("parent", F.floor(F.col("node") / FAN)), parents, ["file", "parent"], "left_semi").drop("parent")
        both = join_on(ours, theirs.select("file", "node", F.col("hash").alias("other")), ["file", "node"])
        suspects = both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node", "other")
    missing = F.when(F.col("other").isNull(), F.lit("missing")).otherwise(F.lit("corrupt"))
    return suspects.select("file", "node", missing.alias("status"))


def read_records(data: bytes) -> list[bytes]:
    """The payloads of the records in the bytes of a file, for tests and small files."""
    out, stream = [], io.BytesIO(gzip.decompress(data))
    while line := stream.readline():
        if line.startswith(b"WARC/"):
            size = 0
            while (head := stream.readline().strip()):
                if head.lower().startswith(b"content-length:"):
                    size = int(head.split(b":")[1])
            out.append(stream.read(size))
            stream.read(4)
    return out
