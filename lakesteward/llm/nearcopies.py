"""Near copies by ProbMinHash: banded signatures of weighted five-word shingles, then exact verification.

A shingle's weight is 1 + ln(times it occurs). Each shingle sends out a Poisson process
of arrivals whose rate is its weight; every arrival falls into one of the registers, and a register
keeps the shingle that arrived first. A shingle stops once its time is past the latest register.
Two registers agree with probability J_P, the probability Jaccard of the weights.

A text that repeats a shingle has a second set of registers, in which every shingle has weight 1; there two registers agree with the plain
Jaccard similarity. For other texts the two sets are the same, so both kinds of links are looked for in the same bands.

Bands of registers bring texts together. In each bucket the text that meets the most
others is the hub; every other member is compared with it, on whole texts. What the links so found
leave in different classes of one bucket is compared too, where sketches of all
registers (a byte of each) allow a similarity near the limit. So a group of copies costs a star
and not all its pairs, and no pair that meets in a bucket is left out.

Texts are linked if J_P or the plain Jaccard of their shingle sets is 0.8 or more (the
two are equal where no shingle repeats). Classes are the connected components, named by their least id.

Defined results: equal texts are one class; a null text counts as empty; a text with one to four words has
one shingle, all its words; a text without words is in a class with its exact copies
only; a null id never names a class that has other ids; an empty table gives an empty result; other
columns are ignored by ``near_copy_classes`` and returned untouched by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import cut, scratch_path
from .groups import components
from .tables import fingerprint, free_name, join_on, text_or_empty
from .words import mix, slices, windows, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 36, 6
REGISTERS = BANDS * ROWS
# A sketch keeps the low byte of every register. At a similarity of 0.8 over 173 of 216 agree; this is four deviations below.
SKETCH_AGREE = 149
ASKING = 500
ANSWERING = 4000
ARRIVALS = 1 << 15
HUB_COPIES = 500


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(text, shingle)`` keys in order, how often each occurs, and the words of each text.

    A key holds the text's place in its upper 16 bits and 48 bits of the shingle's hash.
    """
    words = word_hashes(texts)
    counts = np.diff(words.first)
    hashes, places = windows(words, SHINGLE)
    owner = np.searchsorted(words.first, places, side="right") - 1
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = np.array([
            np.bitwise_xor.reduce(mix(words.hashes[words.first[i]:words.first[i + 1]] + np.arange(counts[i]).astype(np.uint64)))
            for i in short
        ], np.uint64)
        hashes, owner = np.concatenate((hashes, mix(whole))), np.concatenate((owner, short))
    keys = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    if not len(keys):
        return keys, np.zeros(0, np.int64), counts
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[begins], np.diff(np.append(begins, len(keys))), counts


def signatures(keys: np.ndarray, times: np.ndarray, rows: int) -> np.ndarray:
    """Register contents, one line per text; texts without shingles get zeros."""
    latest = np.full(rows, np.inf)
    when = np.full(rows * REGISTERS, np.inf)
    what = np.zeros(rows * REGISTERS, np.uint64)
    text = (keys >> np.uint64(48)).astype(np.int64)
    element = mix(keys & np.uint64((1 << 48) - 1))
    rate = 1.0 + np.log(times)
    clock, seed, draw = np.zeros(len(keys)), element, 0
    while len(text):
        many = int(np.clip(ARRIVALS // len(text), 1, 64))
        draws = (np.arange(draw, draw + many, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        random = mix(seed[:, None] + draws)
        draw += many
        # The upper 40 bits give the waiting time, the lower 24 the register.
        gaps = -np.log(((random >> np.uint64(24)).astype(np.float64) + 0.5) / float(1 << 40)) / rate[:, None]
        arrivals = clock[:, None] + np.cumsum(gaps, axis=1)
        place = (random & np.uint64((1 << 24) - 1)).astype(np.int64) * REGISTERS >> 24
        clock = arrivals[:, -1]
        live = arrivals <= latest[text][:, None]
        at = (text[:, None] * REGISTERS + place)[live]
        time = arrivals[live]
        np.minimum.at(when, at, time)
        first = when[at] == time
        what[at[first]] = np.broadcast_to(element[:, None], live.shape)[live][first]
        touched = np.unique(text)
        latest[touched] = when.reshape(rows, REGISTERS)[touched].max(axis=1)
        on = clock <= latest[text]
        text, element, rate, clock, seed = text[on], element[on], rate[on], clock[on], seed[on]
    return what.reshape(rows, REGISTERS)


def _banded(found: np.ndarray) -> np.ndarray:
    """One hash per band of registers, a line per text."""
    bands = found.reshape(len(found), BANDS, ROWS)
    total = np.zeros((len(found), BANDS), np.uint64)
    for k in range(ROWS):
        total = mix(total + bands[:, :, k] + np.arange(BANDS, dtype=np.uint64))
    return total


def _lists(values: np.ndarray, empty: np.ndarray) -> pa.Array:
    """Lines of BANDS numbers as lists, null where ``empty``."""
    offsets = pa.array(np.arange(0, values.size + 1, BANDS, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1).view(np.int64)), mask=pa.array(empty))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, node, text) to (doc_id, node, bands, plain, sketch).

    Texts without words get null bands, and only texts that repeat a shingle ``plain`` bands; their sketch holds that of the plain registers as well.
    """
    for batch in batches:
        texts = batch.column(2)
        for low, high in slices(texts):
            rows = high - low
            keys, times, counts = shingles(texts.slice(low, rows))
            found = signatures(keys, times, rows)
            owner = (keys >> np.uint64(48)).astype(np.int64)
            repeats = np.bincount(owner, times > 1, rows) > 0
            plain = found
            if repeats.any():
                mine = repeats[owner]
                plain = signatures(keys[mine], np.ones(int(mine.sum()), np.int64), rows)
            sketch = [(a & np.uint64(255)).astype(np.uint8).tobytes() + ((b & np.uint64(255)).astype(np.uint8).tobytes() if r else b"")
                      for a, b, r in zip(found, plain, repeats.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, rows), batch.column(1).slice(low, rows), _lists(_banded(found), counts == 0),
                 _lists(_banded(plain), ~repeats), pa.array(sketch, pa.binary())],
                names=["doc_id", "node", "bands", "plain", "sketch"],
            )


def _probability_jaccard(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> float:
    """J_P of two weightings (sorted keys, weights)."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    shared_p, shared_q = p[i], q[j]
    order = np.argsort(-(shared_p / shared_q), kind="stable")
    x, y = shared_p[order], shared_q[order]
    only_p, only_q = 1.0 - x.sum(), 1.0 - y.sum()
    # Elements only in one text have ratio infinity or zero.
    over = only_p + np.cumsum(x)
    under = only_q + y.sum() - np.cumsum(y)
    return float((1.0 / (over / x + under / y)).sum())


def similar(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Whether each pair of texts is linked."""
    rows = len(left)
    (a, ta, _), (b, tb, _) = shingles(left), shingles(right)
    owner_a, owner_b = (a >> np.uint64(48)).astype(np.int64), (b >> np.uint64(48)).astype(np.int64)
    na, nb = np.bincount(owner_a, minlength=rows), np.bincount(owner_b, minlength=rows)
    both = np.intersect1d(a, b, assume_unique=True)
    shared = np.bincount((both >> np.uint64(48)).astype(np.int64), minlength=rows)
    linked = (shared > 0) & (shared >= SIMILARITY * (na + nb - shared))
    repeats = np.bincount(owner_a, ta, rows) + np.bincount(owner_b, tb, rows) > na + nb
    fa, fb = np.concatenate(([0], np.cumsum(na))), np.concatenate(([0], np.cumsum(nb)))
    for i in np.flatnonzero(~linked & repeats & (shared > 0)):
        s, t = slice(fa[i], fa[i + 1]), slice(fb[i], fb[i + 1])
        linked[i] = _probability_jaccard(a[s], 1.0 + np.log(ta[s]), b[t], 1.0 + np.log(tb[t])) >= SIMILARITY
    return linked


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        for low, high in slices(left):
            rows = high - low
            keep = pa.array(similar(left.slice(low, rows), right.slice(low, rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(low, rows).filter(keep) for i in (0, 1)], names=["u", "v"]
            )


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified pairs of ``hub, member``. A hub's text is copied once for each HUB_COPIES members."""
    # Written first, so that the join back to the pairs of a hub with very many members can be split.
    copies = cut(pairs.groupBy("hub").agg(F.ceil(F.count("*") / HUB_COPIES).cast("int").alias("copies")))
    hubs = join_on(copies.withColumnRenamed("hub", "node"), texts, ["node"]).select(
        F.col("node").alias("hub"), F.col("text").alias("hub_text"), "copies",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"),
    ).drop("copies")
    salted = join_on(pairs, copies, ["hub"]).withColumn("salt", F.pmod(F.xxhash64("member"), F.col("copies")).cast("int"))
    met = join_on(salted.select("hub", "salt", F.col("member").alias("node")), texts, ["node"])
    both = join_on(met, hubs, ["hub", "salt"]).select("hub", F.col("node").alias("member"), "hub_text", "text")
    return both.mapInArrow(_verified, "u binary, v binary")


def near_copy_nodes(docs: DataFrame) -> DataFrame:
    """``node, doc_id, low, class_id``: each different text, its least id, its class and the class's least id."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", fingerprint("text").alias("node"), text_or_empty("text").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = narrow.mapInArrow(_signed, f"doc_id {id_type}, node binary, bands array<long>, plain array<long>, sketch binary")
    path = scratch_path(spark, "signatures")
    signed.write.parquet(path)
    signed = spark.read.schema(signed.schema).parquet(path)

    nodes = cut(signed.groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    # One row per text: of its copies only those with the least id, and of these one.
    single = join_on(signed, nodes, ["node", "doc_id"], null_keys=("doc_id",)).dropDuplicates(["node"]).where("bands is not null")
    both = F.when(F.col("plain").isNull(), F.col("bands")).otherwise(F.concat("bands", "plain"))
    placed = single.select("node", "bands", F.posexplode(both).alias("at", "value"))
    # Where both sets of registers agree on a band, a text stands in its bucket once.
    placed = placed.where((F.col("at") < BANDS) | (F.col("value") != F.get("bands", F.col("at") - BANDS)))
    banded = placed.select("node", (F.col("at") % BANDS).alias("band"), "value")
    buckets = banded.groupBy("band", "value").agg(F.count("*").alias("members")).where("members > 1")
    met = cut(join_on(banded, buckets, ["band", "value"]))
    central = met.groupBy("node").agg(F.sum("members").alias("central"))
    ranked = join_on(met, central, ["node"])
    hubs = ranked.groupBy("band", "value").agg(F.max(F.struct("central", "node")).alias("top"))
    hubs = hubs.select("band", "value", F.col("top.node").alias("hub"))
    pairs = join_on(met, hubs, ["band", "value"]).where("node <> hub").select("hub", F.col("node").alias("member"))
    pairs = cut(pairs.select(F.greatest("hub", "member").alias("a"), F.least("hub", "member").alias("b"), "hub", "member")
                .groupBy("a", "b").agg(F.min(F.struct("hub", "member")).alias("pair")).select("pair.hub", "pair.member"))

    wanted = join_on(central.select("node"), nodes, ["node"])
    text_path = scratch_path(spark, "texts")
    join_on(narrow, wanted, ["node", "doc_id"], null_keys=("doc_id",)).groupBy("node").agg(F.first("text").alias("text")).write.parquet(text_path)
    texts = spark.read.schema("node binary, text string").parquet(text_path)

    links = cut(_links(pairs, texts))
    classes = components(links)
    more = cut(_left_apart(met, single, classes, texts))
    if not more.isEmpty():
        classes = components(links.unionByName(more))
    named = join_on(nodes, classes.withColumnRenamed("u", "node"), ["node"], "left")
    named = named.withColumn("low", F.coalesce("low", "node"))
    least = named.groupBy("low").agg(F.min("doc_id").alias("class_id"))
    return join_on(named, least, ["low"])


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys out of sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *changes.tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            part = batch.slice(low, high - low)
            if held and any(held[0].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between texts of one cell that stand in different classes.

    Each asking text meets the answering ones by falling agreement of the sketches, on whole texts, and passes
    over classes that are already joined with its own. A pair that shares several buckets meets in the first.
    """
    for group in _grouped(batches, ["band", "value", "a", "m"]):
        asks, answers = (np.flatnonzero(group.column(c).to_numpy()) for c in ("asks", "answers"))
        if not len(asks) or not len(answers):
            continue
        group = group.combine_chunks()
        band = group.column("band")[0].as_py()
        nodes, low = group.column("node").to_pylist(), group.column("low").to_pylist()
        sketches = group.column("sketch").to_pylist()
        # Texts that repeat nothing have one set of registers for both.
        sketch, also = (
            np.frombuffer(b"".join(part), np.uint8).reshape(-1, REGISTERS)
            for part in ([x[:REGISTERS] for x in sketches], [x[-REGISTERS:] for x in sketches])
        )
        bands = group.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        plain, second = bands.copy(), group.column("plain").combine_chunks()
        plain[second.is_valid().to_numpy(zero_copy_only=False)] = second.flatten().to_numpy().reshape(-1, BANDS)
        keys, times, _ = shingles(group.column("text").combine_chunks())
        first = np.searchsorted(keys, np.arange(len(nodes) + 1, dtype=np.uint64) << np.uint64(48))
        parts = [(keys[x:y] & np.uint64((1 << 48) - 1), 1.0 + np.log(times[x:y])) for x, y in zip(first, first[1:])]
        root = {c: c for c in low}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        u, v = [], []
        for i in asks.tolist():
            agree = np.maximum((sketch[answers] == sketch[i]).sum(axis=1), (also[answers] == also[i]).sum(axis=1))
            near = np.flatnonzero(agree >= SKETCH_AGREE)
            for j in answers[near[np.argsort(-agree[near], kind="stable")]].tolist():
                mine, other = find(low[i]), find(low[j])
                if mine == other:
                    continue
                shared = (bands[i] == bands[j]) | (plain[i] == plain[j]) | (bands[i] == plain[j]) | (plain[i] == bands[j])
                if int(shared.argmax()) != band:
                    continue
                if _one_link(*parts[i], *parts[j]):
                    root[other] = mine
                    u.append(nodes[i])
                    v.append(nodes[j])
        if u:
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})


def _one_link(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    if not shared:
        return False
    if shared >= SIMILARITY * (len(a) + len(b) - shared):
        return True
    repeats = p.max() > 1 or q.max() > 1
    return bool(repeats and _probability_jaccard(a, p, b, q) >= SIMILARITY)


def _left_apart(met: DataFrame, single: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``u, v`` between texts that share a bucket and not a class.

    Texts outside the bucket's largest class ask, all texts answer. A cell has at most about ASKING
    asking and ANSWERING answering texts, so a large bucket is many cells.
    """
    placed = join_on(met, classes.withColumnRenamed("u", "node"), ["node"], "left")
    placed = cut(placed.select("band", "value", "node", F.coalesce("low", "node").alias("low")))
    sizes = placed.groupBy("band", "value", "low").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("band", "value").agg(F.max(F.struct("n", "low")).alias("major"), F.sum("n").alias("members"))
    mixed = mixed.where("major.n < members").select(
        "band", "value", F.col("major.low").alias("major"),
        F.ceil((F.col("members") - F.col("major.n")) / ASKING).cast("int").alias("across"),
        F.ceil(F.col("members") / ANSWERING).cast("int").alias("down"),
    )
    rows = join_on(placed, cut(mixed), ["band", "value"])
    own_a = F.pmod(F.xxhash64("node"), F.col("across")).cast("int")
    own_m = F.pmod(F.xxhash64("node", F.lit(1)), F.col("down")).cast("int")
    rows = rows.withColumns({"minor": F.col("low") != F.col("major"), "own_a": own_a, "own_m": own_m})

    def cell(a, m, asks, answers):
        return F.struct(a.alias("a"), m.alias("m"), asks.alias("asks"), answers.alias("answers"))

    answering = F.transform(
        F.sequence(F.lit(0), F.col("across") - 1), lambda a: cell(a, F.col("own_m"), F.col("minor") & (a == F.col("own_a")), F.lit(True))
    )
    elsewhere = F.filter(F.sequence(F.lit(0), F.col("down") - 1), lambda m: F.col("minor") & (m != F.col("own_m")))
    asking = F.transform(elsewhere, lambda m: cell(F.col("own_a"), m, F.lit(True), F.lit(False)))
    rows = rows.select("band", "value", "node", "low", F.concat(answering, asking).alias("cells"))
    rows = join_on(join_on(rows, single.select("node", "bands", "plain", "sketch"), ["node"]), texts, ["node"])
    rows = rows.withColumn("cell", F.explode("cells")).select(
        "band", "value", "cell.a", "cell.m", "cell.asks", "cell.answers", "node", "low", "sketch", "bands", "plain", "text"
    )
    cells = ["band", "value", "a", "m"]
    return rows.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(_meet, "u binary, v binary")


def near_copy_classes(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id``, one row per document; the class is named by its least id."""
    nodes = near_copy_nodes(docs)
    rows = docs.select("doc_id", fingerprint("text").alias("node"))
    return join_on(rows, nodes.select("node", "class_id"), ["node"]).select("doc_id", "class_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Of each class the document with the least id (of repeated rows one), columns unchanged."""
    nodes = near_copy_nodes(docs)
    kept = nodes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # Different texts of one class may carry the same id; one of them stays.
    kept = kept.groupBy("low", "doc_id").agg(F.min("node").alias("_node")).select("_node", F.col("doc_id").alias("_id"))
    whole = free_name(docs, "_row")
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), fingerprint("text").alias("_node"), F.col("doc_id").alias("_id")
    )
    # Repeated rows meet before the shuffle, so that many copies of one row do not load one task.
    single = held.groupBy("_node", "_id").agg(F.min_by(whole, F.xxhash64(whole)).alias(whole))
    chosen = join_on(single, kept, ["_node", "_id"], null_keys=("_id",))
    return chosen.select(*[F.col(whole)[c].alias(c) for c in docs.columns])
