"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source is shuffled by a hash of the document id and cut into blocks of equal
numbers of words (the last one may be shorter). Slot i of the mix takes the
golden-ratio point frac((i + 1) * phi), mapped through the cumulative slot shares
of the sources; slots are ranked within their source, and the k-th slot of a
source takes its block k, round after round. The last slot of a source is cut so
that the source's words end at its rounded target.

Defined results: a null or blank text has size 0 and is never taken; a null
source is a source of its own, the last one; repeated rows are separate
documents; an empty table gives an empty mix; other columns are ignored.
Reruns agree, since the order depends on ids and sizes alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import cut
from .tables import free_name, join_on, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 8192
MIN_BLOCKS = 16
GOLDEN = 0.6180339887498949
# Cells of the unit interval in which points and sources meet.
CELLS = 4096
NULL_SOURCE = ("source",)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Targets by source: ``source, source_size, weight, target``.

    Weights repeat over the sources by code point, null last. A source gets its
    weight's part of the share, at most MAX_REPEATS times its size; the excess
    goes to the others by weight. Sorted by limit over weight, the sources at
    their limit come first, so one pass over running sums finds the level.
    The window runs over one row per source, not over documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    limited = totals.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * MAX_REPEATS)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    sums = limited.withColumns({
        "full": F.coalesce(F.sum("most").over(before), F.lit(0)),
        "open": F.sum("weight").over(after),
        "words": F.sum("source_size").over(whole) * F.lit(float(share)),
        "place": F.row_number().over(by_level),
    })
    fits = (F.col("words") - F.col("full")) / F.col("open") <= F.col("most") / F.col("weight")
    # The first row that fits under its limit sets the level for itself and all after it.
    chosen = F.min(F.when(fits, F.struct("place", "words", "full", "open"))).over(whole)
    level = sums.withColumn("level", chosen)
    open_part = F.col("weight") * (F.col("level.words") - F.col("level.full")) / F.col("level.open")
    target = F.when(F.col("place") >= F.col("level.place"), open_part).otherwise(F.col("most").cast("double"))
    return level.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


@dataclass
class Mix:
    """``slots``: one row per slot of the mix with its block; ``pieces``: document parts per slot; ``documents``: sums."""

    slots: DataFrame
    pieces: DataFrame
    documents: DataFrame


def _blocks(targets: DataFrame, block_words: int) -> DataFrame:
    """Block length, blocks of one round, whole rounds, words of the last round and slots of each source."""
    size, quota = F.col("source_size"), F.floor(F.col("target") + 0.5)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.ceil(size / MIN_BLOCKS)))
    sized = targets.withColumns({"quota": quota.cast("long"), "block_words": block.cast("long")})
    sized = sized.withColumn("blocks", F.ceil(size / F.col("block_words")).cast("long"))
    rounds = F.when(size > 0, F.expr("quota div source_size")).otherwise(0).cast("long")
    sized = sized.withColumn("rounds", rounds)
    sized = sized.withColumn("rest", F.col("quota") - F.col("rounds") * size)
    slots = F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / F.col("block_words"))
    return sized.withColumn("slots", slots.cast("long"))


def _prefix(df: DataFrame, keys: list[str], part: str, order: list[Column], value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the same keys, ordered by part, then by order within it.

    Two steps, so that a key with a third of all rows still spreads over its parts.
    """
    inner = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias("_sum"))
    outer = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(outer), F.lit(0))).drop("_sum")
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    joined = join_on(local, bases, [*keys, part], null_keys=tuple(keys))
    return joined.withColumn(out, (F.col("_base") + F.col("_local")).cast("long")).drop("_base", "_local")


def _schedule(spark, sources: DataFrame, total_slots: int) -> DataFrame:
    """``source, k, position``: the k-th slot of each source and its place in the mix.

    Slots beyond a source's share of points go to the end, so each source gets its number exactly.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    share = sources.where("slots > 0").withColumn("below", F.coalesce(F.sum("slots").over(by_name), F.lit(0)))
    spans = share.select(
        "source", "slots", (F.col("below") / total_slots).alias("low"),
        ((F.col("below") + F.col("slots")) / total_slots).alias("high"),
    )
    spans = spans.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))))
    )
    raw = (F.col("id") + 1) * F.lit(GOLDEN)
    points = spark.range(total_slots).withColumn("point", raw - F.floor(raw))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS))
    hit = points.join(spans, "cell").where("low <= point and point < high")
    width = max(1, math.isqrt(total_slots))
    hit = hit.select("source", "slots", "id", F.expr(f"id div {width}").alias("part"))
    ranked = _prefix(hit, ["source"], "part", [F.col("id")], F.lit(1), "k").where("k < slots")
    timed = ranked.select("source", "k", F.col("id").alias("position"))
    got = timed.groupBy("source").agg(F.count("*").alias("got"))
    late = join_on(share.select("source", "slots"), got, ["source"], "left", NULL_SOURCE)
    late = late.withColumn("got", F.coalesce("got", F.lit(0).cast("long"))).where("got < slots")
    late = late.select("source", F.explode(F.expr("sequence(got, slots - 1)")).alias("k"))
    return timed.unionByName(late.select("source", "k", F.col("k") + F.lit(total_slots)).toDF("source", "k", "position"))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS
) -> Mix:
    """The mix of all documents; see the module text for the method and the defined results."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "source", word_count("text").alias("size"))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sized = cut(narrow.withColumns({"key": key, "row": F.monotonically_increasing_id()}))
    rows = sized.count()
    sources = cut(_blocks(source_targets(sized, weights, share), block_words))
    total = sources.agg(F.sum("slots")).first()[0] or 0

    parts = max(1, math.isqrt(rows))
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * parts / F.lit(2**32))
    placed = _prefix(
        sized.withColumn("part", part), ["source"], "part",
        [F.col(c) for c in ("key", "doc_id", "size", "row")], F.col("size"), "start",
    ).drop("part", "key")
    fields = [c for c in sources.columns if c not in ("weight", "source")]
    placed = join_on(placed, sources.select("source", *fields), ["source"], null_keys=NULL_SOURCE)
    slots = _schedule(spark, sources, total) if total else spark.createDataFrame([], "source string, k long, position long")
    slots = join_on(slots, sources.drop("slots"), ["source"], null_keys=NULL_SOURCE).select(
        "source", "k", "position", "block_words", "rest", "rounds",
        F.expr("k div blocks").alias("round"), (F.col("k") % F.col("blocks")).alias("block"),
    )
    # Words of its block that a slot takes: all of them, except in the last, broken round.
    in_block = F.greatest(F.lit(0), F.col("rest") - F.col("block") * F.col("block_words"))
    limit = F.when(F.col("round") < F.col("rounds"), F.col("block_words")).otherwise(F.least("block_words", in_block))
    slots = slots.withColumn("limit", limit.cast("long")).drop("rest", "rounds")

    ends = F.col("start") + F.col("size") - 1
    touched = F.when(F.col("size") > 0, F.sequence(F.expr("start div block_words"), F.floor(ends / F.col("block_words"))))
    parts_of = placed.withColumn("block", F.explode_outer(touched))
    low = F.greatest(F.lit(0), F.col("start") - F.col("block") * F.col("block_words"))
    high = F.least(F.col("block_words"), F.col("start") + F.col("size") - F.col("block") * F.col("block_words"))
    parts_of = parts_of.withColumns({"low": low, "high": high}).drop("block_words", "rest", "rounds", "blocks", "slots", "quota")
    joined = join_on(parts_of, slots.drop("block_words"), ["source", "block"], "left", NULL_SOURCE)
    words = F.greatest(F.lit(0), F.least("high", "limit") - F.col("low"))
    pieces = joined.withColumn("words", F.when(F.col("limit").isNotNull(), words).otherwise(0).cast("long"))
    documents = pieces.groupBy("row", "doc_id", "source", "size", "source_size", "target").agg(
        F.sum("words").alias("taken"), F.min(F.when(F.col("words") > 0, F.col("position"))).alias("first_slot"),
        *[
            F.min(F.when((F.col("words") > 0) & (F.col("round") == n), F.col("position"))).alias(f"slot{n}") for n in range(MAX_REPEATS)
        ],
    ).drop("row")
    return Mix(slots, pieces.where("words > 0").drop("row"), documents)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """Whole documents, each as often as the mix takes the larger part of it (0, 1 or 2 times), columns unchanged, in order of their slots.

    A copy stands where the slot of its round begins it, so every stretch of the result has the sources in about their shares.
    Rows that agree in id, source and size are taken alike.
    """
    slots = [F.min(f"slot{n}").alias(f"_slot{n}") for n in range(MAX_REPEATS)]
    copies = mix_sources(docs, **options).documents.groupBy("doc_id", "source", "size").agg(
        F.max(F.expr("if(size > 0, floor(taken / size + 0.5), 0)")).cast("int").alias("copies"), *slots
    )
    copies = copies.where("copies > 0").toDF("_id", "_source", "_size", "_copies", *[f"_slot{n}" for n in range(MAX_REPEATS)])
    whole = free_name(docs, "_row")
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.col("doc_id").alias("_d"),
        F.col("source").alias("_s"), word_count("text").alias("_n"),
    )
    met = held["_d"].eqNullSafe(copies["_id"]) & held["_s"].eqNullSafe(copies["_source"]) & (held["_n"] == copies["_size"])
    places = F.slice(F.array_compact(F.array(*[F.col(f"_slot{n}") for n in range(MAX_REPEATS)])), F.lit(1), F.col("_copies"))
    # A document that is nearly whole in one round counts as often as its words say.
    filled = F.concat(places, F.array_repeat(F.element_at(places, -1), F.col("_copies") - F.size(places)))
    taken = held.join(copies, met).withColumn("_place", F.explode(filled))
    ordered = taken.sort("_place", F.col("_d").asc_nulls_first())
    return ordered.select(*[F.col(whole)[c].alias(c) for c in docs.columns])
