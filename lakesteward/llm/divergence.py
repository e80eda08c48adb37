"""Audit of how sources differ within a language, by hash-consed segment trees over term ids.

Terms are the runs of letters (A to Z lower-cased, every code point from 0x80 on is one). A language keeps the terms that
MIN_DOCS of its documents hold; they get ids by falling count, so that terms of like counts lie together. The counts of a group
(a source of the language, or all of it) are the leaves of a segment tree over the ids. Equal subtrees of all groups are one node:
a leaf is its count, an inner node the pair of its children. Two trees are walked down together from their roots; a pair of
nodes is priced once, however often it occurs below, and prices are added up on the way back. A price depends on the two groups'
totals too, so it is remembered for a pair of groups.

The trees are cut below their top into blocks of LEAVES ids, and groups into chunks of CHUNK: a task unit holds one block
of two chunks at most, whatever the vocabulary and the number of sources. A block's sums are added up by key.
Smoothed shares are ``p = 1 + floor(SCALE * (count + 2) / (N + 2 V))`` in whole numbers, and a term's price is ``floor((p - q)^2 / (p + q))``.

Defined results: null text, language and source are ''; every occurring group counts, even without terms; a language without kept
terms gives pairs of value 0 and no terms; repeated rows are separate documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import join_on, stored

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
LEAVES = 1024
CHUNK = 48
SLICE_BYTES = 8 << 20
# Node pairs that are priced at once.
PAIRS = 1 << 20
TEXT = "text"
_IS_TERM = np.zeros(256, bool)
_IS_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- terms and counts --------------------------------------------------------

def text_terms(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of some UTF-8 texts, and the number of terms of each text."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    inside = np.zeros(len(joined) + 2, bool)
    inside[1:-1] = _IS_TERM[joined]
    begins, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(joined))]
    begins[edges] = inside[edges + 1]
    ends[edges - 1] = inside[edges]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    body = _LOWER[joined[inside[1:-1]]]
    offsets = np.concatenate(([0], np.cumsum(stops - starts))).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(body))
    return terms, np.diff(np.searchsorted(starts, bounds))


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs), added up over some megabytes of texts at a time."""
    for batch in batches:
        groups = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
        labels = pa.array([f"{len(r['lang'])} {r['lang']} {r['source']}" for r in groups.to_pylist()]).dictionary_encode()
        codes = labels.indices.to_numpy()
        sizes = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right")))
            terms, counts = text_terms(batch.column(2).slice(at, stop - at).cast(pa.binary()).to_pylist())
            if len(terms):
                table = pa.table({"doc": np.repeat(np.arange(at, stop, dtype=np.int32), counts), "term": terms})
                table = table.group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
                doc = table.column("doc").to_numpy()
                table = pa.table({"group": codes[doc], "term": table.column("term"), "n": table.column("count_all")})
                table = table.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
                # One row of each group names it.
                _, first = np.unique(codes, return_index=True)
                row = pa.array(first[table.column("group").to_numpy()])
                yield from pa.table({
                    "lang": batch.column(0).take(row), "source": batch.column(1).take(row), "term": table.column("term").cast(pa.string()),
                    "n": table.column("n_sum"), "docs": table.column("n_count"),
                }).combine_chunks().to_batches()
            at = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of a term in a group, and how many of the group's documents hold it."""
    read = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", TEXT)])
    rows = read.mapInArrow(_term_rows, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _numbered(rows: DataFrame, key: str, order: list, out: str) -> DataFrame:
    """Numbers the rows of each key from 0 in the given order; ranges of rows are numbered apart, so a key may have any number of them."""
    ranged = stored(rows.repartitionByRange(F.col(key), *order).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy(key, "_part").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(key, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    local = ranged.withColumn("_place", F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order)) - 1)
    placed = join_on(local, bases, [key, "_part"])
    return placed.withColumn(out, (F.col("_base") + F.col("_place")).cast("long")).drop("_part", "_place", "_base")


# --- trees -------------------------------------------------------------------

def shares(counts: np.ndarray, bottom: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / bottom), in two steps so that no product leaves 64 bits below counts of 9e13."""
    whole, rest = np.divmod((counts + 2) * 100_000, bottom)
    return 1 + whole * (SCALE // 100_000) + rest * (SCALE // 100_000) // bottom


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Forest:
    """The segment trees of some groups over one block of ids; equal subtrees are one node.

    ``counts[g]`` are a group's leaves. ``levels[0]`` are the different counts; the nodes of level k + 1 are different pairs of
    nodes of level k, whichever group and place they come from. ``roots[g]`` is a group's node at the top level.
    """

    def __init__(self, counts: np.ndarray):
        width = 1 << max(0, int(counts.shape[1] - 1).bit_length())
        # Ids beyond the block's last one are leaves of their own kind, which cost nothing.
        padded = np.full((len(counts), width), -1, np.int64)
        padded[:, :counts.shape[1]] = counts
        self.leaves, nodes = np.unique(padded, return_inverse=True)
        nodes = nodes.reshape(padded.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            size = int(nodes.max(initial=0)) + 1
            both, inner = np.unique(nodes[:, 0::2] * size + nodes[:, 1::2], return_inverse=True)
            self.children.append((both // size, both % size))
            nodes = inner.reshape(len(counts), -1)
        self.roots = nodes[:, 0]

    def priced(self, left: np.ndarray, right: np.ndarray, bottoms: np.ndarray) -> tuple[np.ndarray, int]:
        """Sum of prices over all ids of each pair of groups (``left``, ``right``), and the number of leaf pairs priced."""
        pair, a, b = np.arange(len(left)), self.roots[left], self.roots[right]
        ways = []
        for first, second in reversed(self.children):
            pair, a, b = np.concatenate((pair, pair)), np.concatenate((first[a], second[a])), np.concatenate((first[b], second[b]))
            size = int(max(a.max(initial=0), b.max(initial=0))) + 1
            key = (pair * size + a) * size + b
            known, back = np.unique(key, return_inverse=True)
            ways.append(back)
            pair, a, b = known // (size * size), known // size % size, known % size
        x, y = self.leaves[a], self.leaves[b]
        value = prices(shares(x, bottoms[left[pair]]), shares(y, bottoms[right[pair]]))
        value[x < 0] = 0
        for back in reversed(ways):
            half = len(back) // 2
            value = value[back[:half]] + value[back[half:]]
        return value, len(pair)


def _pairs(ours: int, theirs: int | None, leaves: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of groups of one chunk, or of the first ``ours`` groups with the ``theirs`` behind them, some at a time."""
    if theirs is None:
        left, right = np.triu_indices(ours, 1)
    else:
        left, right = np.repeat(np.arange(ours), theirs), np.tile(np.arange(ours, ours + theirs), ours)
    step = max(1, PAIRS // leaves)
    for at in range(0, len(left), step):
        yield left[at:at + step], right[at:at + step]


RESULT = "lang string, part string, a long, b long, term string, value long"


def _block_prices(rows: pa.Table, leaves: int, chunk: int) -> pa.Table:
    """One block of one chunk with itself, or of two chunks.

    Rows: a group's (``gid``, ``bottom``) without an id; its counts by id; for a chunk with itself also those of the whole language (gid -1) with the terms.
    """
    column = {n: rows.column(n).to_numpy() for n in ("gid", "bottom")}
    low, width, ours, theirs = (rows.column(n)[0].as_py() for n in ("block", "width", "ca", "cb"))
    low, same = low * leaves, ours == theirs
    is_cell = rows.column("id").is_valid().to_numpy(zero_copy_only=False)
    gids, first = np.unique(column["gid"][~is_cell], return_index=True)
    bottoms = column["bottom"][~is_cell][first]
    cells = rows.filter(pa.array(is_cell))
    places, owners = cells.column("id").to_numpy() - low, cells.column("gid").to_numpy()
    counts = np.zeros((len(gids), width), np.int64)
    counts[np.searchsorted(gids, owners), places] = cells.column("n").to_numpy()
    found: list[tuple] = []
    forest = Forest(counts) if width else None
    # Of a chunk with itself the language comes first.
    skip = 1 if same else 0
    ahead = len(gids) - 1 if same else int((gids // chunk == ours).sum())
    for left, right in _pairs(ahead, None if same else len(gids) - ahead, leaves):
        left, right = left + skip, right + skip
        value = forest.priced(left, right, bottoms)[0] if forest else np.zeros(len(left), np.int64)
        found.append((["pair"] * len(left), gids[left], gids[right], [None] * len(left), value))
    if same and forest:
        terms = np.empty(width, object)
        own = owners == -1
        terms[places[own]] = cells.column("term").filter(pa.array(own)).to_pylist()
        for g in range(1, len(gids)):
            # Leaf pairs of the group's tree and the language's are priced once each.
            known, back = np.unique(counts[[g, 0]].T, axis=0, return_inverse=True)
            p, q = shares(known[:, 0], bottoms[g]), shares(known[:, 1], bottoms[0])
            value = np.where((known[:, 0] > 0) & (p > q), prices(p, q), -1)[back.reshape(-1)]
            live = np.flatnonzero(value >= 0)
            if len(live) > TOP:
                live = live[value[live] >= np.partition(value[live], -TOP)[-TOP]]
            best = sorted(live.tolist(), key=lambda i: (-value[i], terms[i].encode()))[:TOP]
            found.append((["term"] * len(best), np.full(len(best), gids[g]), np.full(len(best), -1), terms[best], value[best]))
    part, a, b, term, value = ([x for piece in found for x in piece[k]] for k in range(5))
    lang = rows.column("lang")[0].as_py()
    return pa.table({
        "lang": pa.array([lang] * len(part), pa.string()), "part": pa.array(part, pa.string()), "a": pa.array(a, pa.int64()),
        "b": pa.array(b, pa.int64()), "term": pa.array(term, pa.string()), "value": pa.array(value, pa.int64()),
    })


# --- audit -------------------------------------------------------------------

def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept terms ``lang, term, n, id``; their counts by group ``lang, source, id, n``; and the groups ``lang, source, gid``."""
    counts = stored(term_counts(docs), "terms")
    total = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    terms = stored(_numbered(total.drop("docs"), "lang", [F.col("n").desc(), F.col("term").asc()], "id"), "ids")
    inside = join_on(counts.select("lang", "term", "source", "n"), terms.select("lang", "term", "id"), ["lang", "term"])
    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    numbered = stored(_numbered(groups, "lang", [F.col("source").asc()], "gid"), "groups")
    return terms, stored(inside.select("lang", "source", "id", "n"), "counts"), numbered


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, leaves: int = LEAVES, chunk: int = CHUNK) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group: the other sources of its language, and its TOP leading terms."""
    terms, counts, groups = kept_counts(docs, min_docs)
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("whole"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("sum"))
    heads = join_on(join_on(groups, totals, ["lang", "source"], "left"), sizes, ["lang"], "left")
    heads = heads.withColumn("v", F.coalesce("v", F.lit(0).cast("long")))
    heads = stored(heads.withColumn("bottom", F.coalesce("sum", F.lit(0).cast("long")) + 2 * F.col("v")), "heads")
    langs = heads.groupBy("lang").agg(
        F.max("v").alias("v"), (F.max(F.coalesce("whole", F.lit(0).cast("long"))) + 2 * F.max("v")).alias("whole"),
        F.floor(F.max("gid") / chunk).cast("long").alias("last"),
    )
    wide = heads.select("lang", "source", "gid", "bottom").join(langs.drop("whole"), "lang")
    own_chunk = F.floor(F.col("gid") / chunk).cast("long")
    none = F.lit(None).cast("long")
    blocks = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("v") / leaves) - 1))
    # Every unit of work gets its groups' totals, so that a group without a term in the block counts too.
    head_rows = wide.select("lang", F.explode(blocks).alias("block"), "gid", "bottom", "v", "last", none.alias("id"), none.alias("n"), own_chunk.alias("chunk"))
    cell_rows = join_on(counts, wide, ["lang", "source"]).select(
        "lang", F.floor(F.col("id") / leaves).cast("long").alias("block"), "gid", "bottom", "v", "last", "id", "n", own_chunk.alias("chunk"),
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    no_term = F.lit(None).cast("string").alias("term")
    dealt = head_rows.unionByName(cell_rows).select("*", other.alias("other")).select(
        "lang", "block", F.least("chunk", "other").alias("ca"), F.greatest("chunk", "other").alias("cb"), "gid", "bottom", "v", "id", "n", no_term,
    )
    # The language's own counts go to the units of a chunk with itself.
    own = langs.select("lang", "v", "last", F.col("whole").alias("bottom"))
    lang_heads = own.select("lang", F.explode(blocks).alias("block"), "bottom", "v", "last", none.alias("id"), none.alias("n"), no_term)
    lang_cells = join_on(terms, own, ["lang"]).select(
        "lang", F.floor(F.col("id") / leaves).cast("long").alias("block"), "bottom", "v", "last", "id", "n", "term",
    )
    lang_rows = lang_heads.unionByName(lang_cells).select("*", other.alias("ca")).select(
        "lang", "block", "ca", F.col("ca").alias("cb"), F.lit(-1).cast("long").alias("gid"), "bottom", "v", "id", "n", "term",
    )
    units = dealt.unionByName(lang_rows).withColumn(
        "width", F.least(F.lit(leaves).cast("long"), F.col("v") - F.col("block") * leaves)
    ).drop("v")
    found = stored(units.groupBy("lang", "block", "ca", "cb").applyInArrow(lambda rows: _block_prices(rows, leaves, chunk), RESULT), "prices")

    pairs = found.where("part = 'pair'").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "value")
    names = groups.select("lang", "gid", "source")
    named = join_on(both.select("lang", F.col("p.a").alias("gid"), F.col("p.b").alias("other"), "value"), names, ["lang", "gid"])
    named = join_on(named, names.toDF("lang", "other", "item"), ["lang", "other"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    led = join_on(found.where("part = 'term'").select("lang", F.col("a").alias("gid"), F.col("term").alias("item"), "value"), names, ["lang", "gid"])
    led = led.select("lang", "source", F.lit("term").alias("part"), "item", "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    ranked = named.withColumn("rank", F.row_number().over(by_value))
    return ranked.unionByName(led.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= TOP))
