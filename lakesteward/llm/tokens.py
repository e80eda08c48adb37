"""Token ids in binary shards with a minimal perfect hash index over document keys.

Shard file: a header of six little-endian unsigned 64-bit numbers (magic, bytes an
id, documents, ids, 0, 0), then the documents' lengths as unsigned 32-bit numbers,
then the raw ids, unsigned 16 or 32 bits wide as the vocabulary needs. Documents lie
in ascending id order, within a shard and from shard to shard. ``manifest`` is a Parquet
table of the files that count: a file of a lost or repeated task is in none.

Index file: keys are dealt to index files by hash. Each file holds a minimal perfect
hash: in every level a key that is alone on its bit of the level's bit array is
placed there, the others go to the next level; the rank of a set bit among
all bits is the key's slot. A slot has the key's stored fingerprint and its runs
(shard, first document, documents, first id); a key that is not in the index is known by
its fingerprint, or by having no bit.

Defined results: a null text is empty and has the end id alone; a null id is a key of its own,
before all others; repeated ids give one run per shard; an empty table gives no files; other columns
are ignored.
"""

from __future__ import annotations

import array
import functools
import io
import json
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .lookup import Table, stretch_hashes
from .tables import text_or_empty
from .words import word_spans

MAGIC = 0x314B4F54
SHARD_BYTES = 32 << 20
INDEX_KEYS = 100_000
LEVEL_BITS = 2
MAX_LEVELS = 60
# Places of remembered pieces, and ids of them at most; an entry's lower bits are its number of ids.
TABLE_BITS = 20
KEPT_IDS = 4 << 20
SPOT_BITS = 28
SLICE_BYTES = 1 << 20
AFTER_BLANK = re.compile(rb"[\x20\x09-\x0D]")

READ_BYTES = 4 << 20
# Letters that neither case folding nor composition changes in number, and how byte-level models write them.
LETTERS = "".join(c for c in map(chr, [*range(65, 91), *range(97, 123), *range(192, 256)]) if c.isalpha())
SIMPLE = re.compile(f"([{LETTERS}]+)([.,;:!?%$#&*]*)").fullmatch
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_WRITTEN = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in set(_SHOWN))}
LETTER_BYTES = {ord(c): "".join(_WRITTEN[b] for b in c.encode()) for c in LETTERS if ord(c) > 127}
MANIFEST = "shard int, file string, docs long, ids long"
INDEX_FILES = "part int, parts int, file string, keys long"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or an absolute path, for tasks that write and read files themselves."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def drops_blanks(tokenizer) -> bool:
    """Whether the tokenizer's file says that blanks part a text into pieces which are encoded by themselves.

    So it is if a split keeps only what its pattern matches, the pattern matches no blank, nothing before that
    step looks across blanks, and no added token holds or takes one.
    """
    parts = json.loads(tokenizer.to_str())

    def steps(part: dict | None, inner: str) -> list[dict]:
        return part[inner] if part and part["type"] == "Sequence" else [part] if part else []

    first = (steps(parts["pre_tokenizer"], "pretokenizers") or [{}])[0]
    if first.get("type") != "Split" or first["behavior"] != "Removed" or not first["invert"]:
        return False
    for step in steps(parts["normalizer"], "normalizers"):
        plain = step["type"] in ("NFC", "Lowercase")
        blanks = step["type"] == "Replace" and step["pattern"] == {"Regex": r"\s+"} and step["content"] == " "
        if not plain and not blanks:
            return False
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in parts["added_tokens"]):
        return False
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    for blank in " \t\n\v\f\r":
        for a in "a1!'":
            for b in "as1!'":
                joined = [p for p, _ in split(f"{a}{blank}{b}")]
                if joined != [p for p, _ in split(a)] + [p for p, _ in split(b)]:
                    return False
    return True


class Encoder:
    """Ids of whole texts as little-endian bytes.

    ``independent`` says that the tokenizer drops white space and never joins what it
    separates (None: as its file says); then texts are parted at blanks, whole batches at once, and each piece is looked up by its hashes in a
    table of places in one array that holds the ids of all remembered pieces. Pieces that are not there are encoded, each once
    a batch. The array is emptied when it holds KEPT_IDS ids.
    """

    def __init__(self, tokenizer_path: str, end_id: int, independent: bool | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.type = np.dtype("<u2" if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.type).tobytes()
        independent = drops_blanks(self.tokenizer) if independent is None else independent
        self.independent = independent
        self.tokenize, self.signs = self.tokenizer.model.tokenize, {}
        self.table, self.kept = Table(TABLE_BITS), np.zeros(1 << 16, self.type)
        self._forget()
        # The short way is taken only if it gives what the whole tokenizer gives for all letters and signs.
        self.code = "H" if self.type.itemsize == 2 else "I"
        probes = [f"{c}{d}{s}" for c, d in zip(LETTERS, LETTERS[7:] + LETTERS) for s in ("", ".", "!?", "%", "$#&*", ",;:")]
        self.direct = independent and [self._by_model(p) for p in probes] == self._encode(probes)

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.type).tobytes() for e in found]

    def _by_model(self, piece: str) -> bytes | None:
        """Ids of letters and then signs, straight from the model; None for other pieces."""
        parts = SIMPLE(piece)
        if not parts:
            return None
        letters, signs = parts.groups()
        letters = letters.lower()
        found = self.tokenize(letters if letters.isascii() else letters.translate(LETTER_BYTES))
        ids = array.array(self.code, [t.id for t in found]).tobytes()
        if signs:
            tail = self.signs.get(signs)
            if tail is None:
                if len(self.signs) > 10_000:
                    self.signs.clear()
                tail = self.signs[signs] = array.array(self.code, [t.id for t in self.tokenize(signs)]).tobytes()
            ids += tail
        return ids

    def _encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        if self.direct:
            make = self._by_model
            out = {p: ids for p in pieces if (ids := make(p)) is not None}
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self._encode(rest)))
        return out

    def _forget(self) -> None:
        """Empties the table; the first place holds the end id."""
        self.table.clear()
        self.kept[0] = np.frombuffer(self.end, self.type)[0]
        self.used = 1

    def _keep(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes pieces and adds their ids to the array: first id and number of ids of each."""
        known = self._encode_pieces(pieces)
        ids = [known[p] for p in pieces]
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // self.type.itemsize
        firsts = self.used + np.cumsum(counts) - counts
        total = int(counts.sum())
        if self.used + total > len(self.kept):
            grown = np.zeros(max(self.used + total, 2 * len(self.kept)), self.type)
            grown[:self.used] = self.kept[:self.used]
            self.kept = grown
        self.kept[self.used:self.used + total] = np.frombuffer(b"".join(ids), self.type)
        self.used += total
        return firsts, counts

    def _slice(self, whole: list[bytes]) -> list[np.ndarray]:
        """Ids of some UTF-8 texts, without end ids."""
        joined = b"".join(whole)
        data = np.frombuffer(joined, np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in whole]))).astype(np.int64)
        starts, ends = word_spans(data, bounds[:-1])
        keys, checks = stretch_hashes(data, starts, ends)
        if self.used > KEPT_IDS:
            self._forget()
        spots = self.table.get(keys, checks)
        missed = np.flatnonzero(spots == 0)
        if len(missed):
            both = np.stack([keys[missed], checks[missed].astype(np.uint64)], axis=1)
            _, new, back = np.unique(both, axis=0, return_index=True, return_inverse=True)
            new = missed[new]
            pieces = [joined[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            first, count = self._keep(pieces)
            spot = first << SPOT_BITS | count
            self.table.put(keys[new], checks[new], spot)
            spots[missed] = spot[back.reshape(-1)]
        counts = spots & ((1 << SPOT_BITS) - 1)
        ends_at = np.cumsum(counts)
        gather = np.repeat((spots >> SPOT_BITS) - (ends_at - counts), counts)
        gather += np.arange(len(gather))
        ids = self.kept[gather]
        words = np.searchsorted(starts, bounds)
        edges = np.concatenate(([0], ends_at))[words]
        return [ids[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.independent:
            return [ids + self.end for ids in self._encode(texts)]
        out: list[list[bytes]] = [[] for _ in texts]
        parts, owners, held = [], [], 0

        def flush() -> None:
            for i, ids in zip(owners, self._slice(parts) if parts else []):
                out[i].append(ids.tobytes())

        for i, text in enumerate(texts):
            whole, at = text.encode(), 0
            while at < len(whole):
                stop = len(whole)
                if stop - at > SLICE_BYTES:
                    # Long texts are parted between pieces.
                    blank = AFTER_BLANK.search(whole, at + SLICE_BYTES)
                    stop = blank.end() if blank else stop
                parts.append(whole[at:stop])
                owners.append(i)
                held += stop - at
                at = stop
                if held >= SLICE_BYTES:
                    flush()
                    parts, owners, held = [], [], 0
        flush()
        return [b"".join([*ids, self.end]) for ids in out]


@functools.lru_cache(maxsize=2)
def _encoder(tokenizer_path: str, end_id: int, independent: bool | None) -> Encoder:
    """One encoder for all tasks of a worker process."""
    return Encoder(tokenizer_path, end_id, independent)


def _shard_writer(path: str, make_encoder: Callable[[], Encoder]):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.bin"
        encoder, lengths, total, out = make_encoder(), [], 0, None
        store, root = _open(path)
        body = runs = None
        h1s, h2s = [], []
        for batch in batches:
            texts = batch.column(0)
            for at in range(0, len(texts), 256):
                for ids in encoder.encode(texts.slice(at, 256).to_pylist()):
                    lengths.append(len(ids) // encoder.type.itemsize)
                    if out is None:
                        store.create_dir(root, recursive=True)
                        body = f"{root}/{name}.ids"
                        out = store.open_output_stream(body)
                    out.write(ids)
            h1s.append(batch.column(1).to_numpy())
            h2s.append(batch.column(2).to_numpy())
        if out is None:
            return
        out.close()
        counts = np.array(lengths, "<u4")
        total = int(counts.sum(dtype=np.int64))
        # The documents' lengths are known only now; they get a file of their own beside the raw ids.
        with store.open_output_stream(f"{root}/{name}.len") as head:
            head.write(np.array([MAGIC, encoder.type.itemsize, len(counts), total, 0, 0], "<u8").tobytes())
            head.write(counts.tobytes())
        h1, h2 = np.concatenate(h1s), np.concatenate(h2s)
        begins = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        starts = np.cumsum(counts, dtype=np.int64) - counts
        docs = np.diff(np.append(begins, len(h1)))
        n = len(begins)
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(["run"] * n + ["shard"]),
            "h1": pa.array([*h1[begins], 0], pa.int64()), "h2": pa.array([*h2[begins], 0], pa.int64()),
            "shard": pa.array([context.partitionId()] * (n + 1), pa.int32()),
            "file": pa.array([None] * n + [name]),
            "first_doc": pa.array([*begins, 0], pa.int64()), "docs": pa.array([*docs, len(counts)], pa.int64()),
            "first_id": pa.array([*starts[begins], 0], pa.int64()), "ids": pa.array([0] * n + [total], pa.int64()),
        })

    return write


def _hash_columns(key: str):
    """Two hashes of a key of any type; null has hashes too."""
    return F.xxhash64(F.col(key), F.lit(1)).alias("h1"), F.xxhash64(F.col(key), F.lit(2)).alias("h2")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, independent: bool | None = None) -> None:
    """Writes the shards, the manifest and the index of all documents under ``path``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_or_empty("text")))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    narrow = docs.select(text_or_empty("text").alias("text"), *_hash_columns("doc_id"), F.col("doc_id").alias("_id"))
    # Rows of one id, or of none, go on by their texts, and whole copies by their place in the input, so that none of
    # them fills one task; the index has a run of an id in each shard.
    order = [F.col("_id").asc_nulls_first(), F.col("_begin"), F.col("_mark")]
    ranged = narrow.withColumns({
        "_begin": F.substring("text", 1, 32), "_mark": F.xxhash64("text"), "_row": F.monotonically_increasing_id(),
    }).repartitionByRange(shards, *order, F.col("_row"))
    ordered = ranged.sortWithinPartitions(*order).select("text", "h1", "h2")
    written = ordered.mapInArrow(
        _shard_writer(f"{path}/shards", lambda: _encoder(tokenizer_path, end_id, independent)),
        "kind string, h1 long, h2 long, shard int, file string, first_doc long, docs long, first_id long, ids long",
    )
    written.write.parquet(f"{path}/runs")
    told = spark.read.schema(written.schema).parquet(f"{path}/runs")
    told.where("kind = 'shard'").select("shard", "file", "docs", "ids").coalesce(1).write.parquet(f"{path}/manifest")
    runs = told.where("kind = 'run'").select("h1", "h2", "shard", "first_doc", "docs", "first_id")
    write_index(runs, path)


# --- minimal perfect hash ----------------------------------------------------

def _mixed(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    from .words import mix

    return mix(h1 ^ mix(h2 + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))


def build_mph(h1: np.ndarray, h2: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of all levels, and each key's slot. Keys must differ in h1 or h2."""
    levels, slots = [], np.full(len(h1), -1, np.int64)
    left, placed = np.arange(len(h1)), 0
    while len(left):
        if len(levels) == MAX_LEVELS:
            raise ValueError("equal keys in the index")
        width = max(64, LEVEL_BITS * len(left))
        at = (_mixed(h1[left], h2[left], len(levels)) % np.uint64(width)).astype(np.int64)
        hits = np.bincount(at, minlength=width)
        alone = hits == 1
        ranks = np.cumsum(alone) - 1
        lucky = alone[at]
        slots[left[lucky]] = placed + ranks[at[lucky]]
        placed += int(alone.sum())
        levels.append(alone)
        left = left[~lucky]
    return levels, slots


class Index:
    """One index file in memory: ``find`` maps hashes to slots, -1 where the key is not in it."""

    def __init__(self, data: bytes):
        with np.load(io.BytesIO(data)) as parts:
            self.widths, bits = parts["widths"], parts["bits"]
            self.prints, self.row = parts["prints"], parts["row"]
            self.runs = {k: parts[k] for k in ("shard", "first_doc", "docs", "first_id")}
        # Words of 64 bits, most significant bit first, and the set bits before each word.
        self.words = np.frombuffer(bits.tobytes() + bytes(-len(bits) % 8), ">u8").astype(np.uint64)
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        slots = np.full(len(h1), -1, np.int64)
        open_, base = np.arange(len(h1)), 0
        for level, width in enumerate(self.widths):
            if not len(open_):
                break
            at = base + (_mixed(h1[open_], h2[open_], level) % np.uint64(width)).astype(np.int64)
            word, place = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> (np.uint64(63) - place)) & np.uint64(1) == 1
            before = np.bitwise_count((word >> np.uint64(1)) >> (np.uint64(63) - place))
            slots[open_[hit]] = (self.ranks[at >> 6] + before)[hit]
            open_, base = open_[~hit], base + int(width)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == h2[known]
        slots[~known] = -1
        return slots


def _index_file(part: dict[str, np.ndarray]) -> tuple[bytes, int]:
    """The bytes of one index file over the runs of its keys, and the number of keys."""
    a, b = part["h1"].view(np.uint64), part["h2"].view(np.uint64)
    begins = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    levels, slots = build_mph(a[begins], b[begins])
    counts = np.diff(np.append(begins, len(a)))
    by_slot = np.argsort(slots)
    row = np.concatenate(([0], np.cumsum(counts[by_slot])))
    runs = np.repeat(begins[by_slot] - row[:-1], counts[by_slot]) + np.arange(len(a))
    out = io.BytesIO()
    np.savez(
        out, widths=np.array([len(x) for x in levels], np.int64), bits=np.packbits(np.concatenate(levels)),
        prints=b[begins][by_slot], row=row,
        **{k: part[k][runs] for k in ("shard", "first_doc", "docs", "first_id")},
    )
    return out.getvalue(), len(begins)


def _index_writer(path: str, parts: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filled = [b for b in batches if b.num_rows]
        if not filled:
            return
        data = pa.Table.from_batches(filled)
        column = {n: data.column(n).to_numpy() for n in data.column_names}
        order = np.lexsort([column[n] for n in ("first_id", "shard", "h2", "h1", "part")])
        column = {n: v[order] for n, v in column.items()}
        store, root = _open(path)
        store.create_dir(root, recursive=True)
        rows = []
        numbers, firsts = np.unique(column["part"], return_index=True)
        for number, low, high in zip(numbers.tolist(), firsts, np.append(firsts[1:], len(order))):
            body, keys = _index_file({n: v[low:high] for n, v in column.items()})
            name = f"index-{number:06d}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}.npz"
            with store.open_output_stream(f"{root}/{name}") as file:
                file.write(body)
            rows.append({"part": number, "parts": parts, "file": name, "keys": keys})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([
            ("part", pa.int32()), ("parts", pa.int32()), ("file", pa.string()), ("keys", pa.int64()),
        ]))

    return write


def write_index(runs: DataFrame, path: str) -> None:
    """One index file per part of the key hash; a part has about INDEX_KEYS runs."""
    parts = max(1, -(-runs.count() // INDEX_KEYS))
    dealt = runs.withColumn("part", F.pmod(F.col("h1"), F.lit(parts)).cast("int")).repartition(parts, "part")
    dealt.mapInArrow(_index_writer(f"{path}/index", parts), INDEX_FILES).coalesce(1).write.parquet(f"{path}/index_files")


# --- reading -----------------------------------------------------------------

def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """``key, shard, first_doc, docs, first_id`` of each given key that the index has; keys must be distinct."""
    files = spark.read.schema(INDEX_FILES).parquet(f"{path}/index_files")
    total = files.agg(F.max("parts")).first()[0]
    schema = f"{key} {keys.schema[key].dataType.simpleString()}, shard int, first_doc long, docs long, first_id long"
    if total is None:
        return spark.createDataFrame([], schema)
    asked = keys.select(F.col(key).alias("key"), *_hash_columns(key))
    asked = asked.withColumn("part", F.pmod(F.col("h1"), F.lit(total)).cast("int")).join(files.select("part", "file"), "part")
    asked = asked.repartition(total, "part").sortWithinPartitions("part").select("key", "h1", "h2", "file")
    root_path = f"{path}/index"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(root_path)
        name, index = None, None
        for batch in batches:
            names = batch.column(3).to_pylist()
            at = 0
            while at < len(names):
                stop = at + 1
                while stop < len(names) and names[stop] == names[at]:
                    stop += 1
                if names[at] != name:
                    name = names[at]
                    with store.open_input_stream(f"{root}/{name}") as file:
                        index = Index(file.read())
                h1 = batch.column(1).slice(at, stop - at).to_numpy().view(np.uint64)
                h2 = batch.column(2).slice(at, stop - at).to_numpy().view(np.uint64)
                slots = index.find(h1, h2)
                known = np.flatnonzero(slots >= 0)
                counts = (index.row[slots[known] + 1] - index.row[slots[known]]).astype(np.int64)
                runs = np.repeat(index.row[slots[known]] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at).take(pa.array(np.repeat(known, counts)))]
                    + [pa.array(index.runs[k][runs]) for k in ("shard", "first_doc", "docs", "first_id")],
                    names=[key, "shard", "first_doc", "docs", "first_id"],
                )
                at = stop

    return asked.mapInArrow(find, schema)


def read_documents(spark: SparkSession, path: str, found: DataFrame, key: str) -> DataFrame:
    """``key, start, n_tokens, ids`` of each document of the found runs, its ids as little-endian 32-bit bytes.

    ``start`` counts the ids of all shards and documents before it.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    placed = found.join(bases.select("shard", "file", "base"), "shard")
    shards = max(1, manifest.count())
    placed = placed.repartition(shards, "shard").sortWithinPartitions("shard", "first_id")
    placed = placed.select(F.col(key).alias("key"), "file", "base", "first_doc", "docs", "first_id")
    root_path = f"{path}/shards"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(root_path)
        name = payload = lengths = None
        for batch in batches:
            keys, rows = batch.column(0), batch.drop_columns(["key"]).to_pylist()
            which, starts, counts, blobs, held = [], [], [], [], 0
            for i, row in enumerate(rows):
                if row["file"] != name:
                    name = row["file"]
                    with store.open_input_stream(f"{root}/{name}.len") as file:
                        head = file.read()
                    magic, width, docs = np.frombuffer(head, "<u8", 3)
                    if magic != MAGIC:
                        raise ValueError(f"{name} is no token shard")
                    lengths = np.frombuffer(head, "<u4", int(docs), 48)
                    kind = np.dtype(f"<u{width}")
                    if payload:
                        payload.close()
                    payload = store.open_input_file(f"{root}/{name}.ids")
                sizes = lengths[row["first_doc"]:row["first_doc"] + row["docs"]]
                payload.seek(row["first_id"] * kind.itemsize)
                at = row["first_id"]
                for size in sizes.tolist():
                    blob = payload.read(size * kind.itemsize)
                    which.append(i)
                    starts.append(row["base"] + at)
                    counts.append(size)
                    blobs.append(np.frombuffer(blob, kind).astype("<u4").tobytes())
                    at += size
                    held += 4 * size
                    if held >= READ_BYTES or len(blobs) == 4096:
                        yield _documents(keys, which, starts, counts, blobs)
                        which, starts, counts, blobs, held = [], [], [], [], 0
            if blobs:
                yield _documents(keys, which, starts, counts, blobs)
        if payload:
            payload.close()

    return placed.mapInArrow(read, f"{key} {found.schema[key].dataType.simpleString()}, start long, n_tokens long, ids binary")


def _documents(keys, which, starts, counts, blobs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [keys.take(pa.array(which)), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
        names=["key", "start", "n_tokens", "ids"],
    )
