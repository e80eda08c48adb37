"""Repeated runs of lines, by a suffix array over line ids that prefix doubling builds level by level.

Lines with a word are the letters; blank lines are kept and never counted. Level 0 ranks the
lines that occur more than once. Level k + 1 ranks the runs of 2^(k+1) lines that
occur more than once, in order of the pair of ranks of their two halves; the places of such runs are the part of
the suffix array in which neighbours share as many lines, and the runs of one rank are an interval of a longest
common prefix of at least that length. Only places that are still repeated go on, so each level is smaller.

A place's length is the largest number of lines that an earlier place has as well. Between 2^k, the highest level where its
class has an earlier place, and 2^(k+1) it is found by halving: runs of n lines are alike if their first and their last 2^k lines are.
If that run has MIN_WORDS words or more, it is a later copy, and its lines are deleted; the earliest place keeps them. Documents count in order of their id.

Defined results: a null text stays null and has no lines; a null id comes before all others; rows that repeat id and text are one
document and get equal results; a run inside one document that repeats an earlier part of it is a copy too;
an empty table gives an empty result; other columns are ignored, or returned untouched by ``dedup_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import BLANKS, fingerprint, free_name, join_on, stored, text_or_empty

MIN_WORDS = 50
# Places are numbered document * LINES + line.
LINES = 1 << 26
MAX_LEVELS = 26
# Levels are written in files of so many rows, so that the small ones of high levels cost few tasks.
FILE_ROWS = 250_000
KEYS = ["doc_id", "mark"]
NULL_ID = ("doc_id",)


def _written(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Written and read back; with ``rows``, which it has at most, in as many files as they need."""
    return stored(df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS))), "lines")


def _has_word(line: Column) -> Column:
    return line.rlike(f"[^{BLANKS}]")


def _numbered(distinct: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Numbers distinct rows from 0 in the given order, without a task that sees them all.

    Rows are dealt out by ranges; the row counts of the ranges before come from one row per range.
    """
    ranged = _written(distinct.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    local = ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    placed = join_on(local, bases, ["_part"])
    return placed.withColumn(out, (F.col("_base") + F.col("_place")).cast("long")).drop("_part", "_place", "_base")


def _repeated_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Level 0: ``pos, rank, words, place`` of each line that occurs more than once; and the documents' numbers.

    ``pos`` counts a document's lines with a word, ``place`` all its lines.
    """
    keyed = docs.where("text is not null").select("doc_id", fingerprint("text").alias("mark"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark").asc()]
    numbers = _written(_numbered(keyed.select(*KEYS).distinct(), order, "doc"))
    every = F.transform(F.split("text", "\n"), lambda body, place: F.struct(body.alias("body"), place.alias("place")))
    lines = keyed.select(*KEYS, F.posexplode(F.filter(every, lambda x: _has_word(x["body"]))).alias("line", "held"))
    lines = lines.select(*KEYS, "line", F.col("held.place").alias("place"), F.col("held.body").alias("body")).select(
        *KEYS, "line", "place", F.xxhash64("body").alias("h1"), F.xxhash64("body", F.lit(1)).alias("h2"),
        F.regexp_count("body", F.lit(f"[^{BLANKS}]+")).alias("words"),
    )
    often = _written(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"))
    ranks = _written(_numbered(often, [F.col("h1").asc(), F.col("h2").asc()], "rank"))
    kept = join_on(join_on(lines, ranks, ["h1", "h2"]), numbers, KEYS, null_keys=NULL_ID)
    # A place that repeated rows give twice is one place.
    placed = kept.select((F.col("doc") * LINES + F.col("line")).alias("pos"), "rank", "words", "place")
    placed = _written(placed.groupBy("pos").agg(*[F.min(c).alias(c) for c in ("rank", "words", "place")]))
    return _written(_still_repeated(placed)), numbers


def _still_repeated(placed: DataFrame) -> DataFrame:
    """Without ranks that only repeated rows of one document made look repeated."""
    counts = placed.groupBy("rank").agg(F.count("*").alias("_n")).where("_n > 1").select("rank")
    return join_on(placed, _written(counts), ["rank"])


def _doubled(level: DataFrame, step: int, rows: int) -> DataFrame:
    """``pos, rank`` of the repeated runs of twice the length; ``rows`` are those of the level."""
    ahead = level.select((F.col("pos") - step).alias("pos"), F.col("rank").alias("second"))
    pairs = _written(join_on(level.select("pos", F.col("rank").alias("first")), ahead, ["pos"]), rows)
    often = pairs.groupBy("first", "second").agg(F.count("*").alias("n")).where("n > 1").select("first", "second")
    ranks = _written(_numbered(often, [F.col("first").asc(), F.col("second").asc()], "rank"), rows)
    return _written(join_on(pairs, ranks, ["first", "second"]).select("pos", "rank"), rows)


def repeated_levels(base: DataFrame) -> list[DataFrame]:
    """Level k: ``pos, rank`` of all places whose next 2^k lines occur at another place too."""
    levels, rows = [base.select("pos", "rank")], base.count()
    while len(levels) <= MAX_LEVELS:
        level = _doubled(levels[-1], 1 << (len(levels) - 1), rows)
        rows = level.count()
        if not rows:
            break
        levels.append(level)
    return levels


def _partners(levels: list[DataFrame]) -> DataFrame:
    """``pos, partner, top``: of each later place the earliest place with the same 2^top lines, for the largest such top."""
    found = None
    for k, level in enumerate(levels):
        firsts = level.groupBy("rank").agg(F.min("pos").alias("partner"))
        later = join_on(level, firsts, ["rank"]).where("partner < pos").select("pos", "partner", F.lit(k).alias("top"))
        found = later if found is None else found.unionByName(later)
    best = found.groupBy("pos").agg(F.max(F.struct("top", "partner")).alias("best"))
    return _written(best.select("pos", "best.partner", "best.top"), levels[0].count())


def _longest(pairs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``pos, partner, length``: the most lines that each place shares with an earlier one, and the earliest such place.

    Places with the same partner and length so far share these lines. At each step those that also share the next ones form a
    class, with the partner if it does too; the first of a class stays with the lines it has, and is the partner of the others.
    Any earlier place with more lines is found so: the earliest of its class stands in for it.
    """
    state = pairs.select("pos", "partner", "top", F.expr("shiftleft(1L, top)").alias("length"))
    rows = pairs.count()
    done = state.where("top = 0")
    for halving in range(1, len(levels)):
        ranks = None
        for k in range(halving, len(levels)):
            level = levels[k].select(F.lit(k).alias("top"), F.col("pos").alias("at"), "rank")
            ranks = level if ranks is None else ranks.unionByName(level)
        ahead = F.expr(f"length + shiftleft(1L, top - {halving}) - shiftleft(1L, top)")
        looked = state.where(F.col("top") >= halving).withColumns({"at": F.col("pos") + ahead, "other": F.col("partner") + ahead})
        looked = join_on(looked, ranks, ["top", "at"], "left")
        looked = _written(join_on(looked, ranks.toDF("top", "other", "also"), ["top", "other"], "left"), rows)
        keys = ["top", "partner", "length", "rank"]
        apart = looked.where("rank IS NOT NULL AND NOT rank <=> also")
        firsts = apart.groupBy(*keys).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1").select(*keys, "first")
        met = join_on(looked, firsts, keys, "left")
        behind = F.col("first") < F.col("pos")
        longer = F.when(behind, True).when(F.col("rank") == F.col("also"), True).otherwise(False)
        state = _written(met.select(
            "pos", F.when(behind, F.col("first")).otherwise(F.col("partner")).alias("partner"), "top",
            (F.col("length") + F.when(longer, F.expr(f"shiftleft(1L, top - {halving})")).otherwise(0)).alias("length"),
        ), rows)
        rows = state.count()
        done = done.unionByName(state.where(F.col("top") == halving))
    return done.select("pos", "partner", "length")


def later_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc, place`` of every line to delete, and the documents' numbers."""
    base, numbers = _repeated_lines(docs)
    levels = repeated_levels(base)
    runs = _longest(_partners(levels), levels)
    doc = F.floor(F.col("pos") / LINES).cast("long")
    in_order = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = _written(base.withColumn("doc", doc).withColumn("total", F.sum("words").over(in_order)))
    ends = summed.select((F.col("pos") + 1).alias("end"), F.col("total").alias("last"))
    sized = join_on(runs.withColumn("end", F.col("pos") + F.col("length")), ends, ["end"]).select("pos", "end", "last")
    reach = join_on(summed, sized, ["pos"], "left")
    long_enough = F.when(F.col("last") - F.col("total") + F.col("words") >= MIN_WORDS, F.col("end"))
    reached = reach.withColumn("reach", F.max(long_enough).over(in_order)).where("reach > pos")
    return reached.select("doc", "place"), numbers


def _removed(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, removed``: the places of a document's deleted lines among all its lines."""
    lines, numbers = later_copies(docs)
    lists = lines.groupBy("doc").agg(F.collect_list("place").alias("removed"))
    return join_on(lists, numbers, ["doc"]).select(*KEYS, "removed")


def _left(lines: Column, removed: Column) -> Column:
    """The text of the lines that are not removed. ``lines`` must be a column, as an expression would be evaluated for each line."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
    return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of each document; lines are those with a word."""
    held = docs.select("doc_id", fingerprint("text").alias("mark"), "text")
    joined = join_on(held, _removed(docs), KEYS, "left", NULL_ID)
    joined = joined.withColumn("lines", F.split(text_or_empty("text"), "\n"))
    n_lines = F.size(F.filter("lines", _has_word))
    left = F.when(F.col("removed").isNotNull(), _left(F.col("lines"), F.col("removed"))).otherwise(F.col("text"))
    return joined.select(
        "doc_id", n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), left.alias("text"),
    )


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The table with the texts that are left; other columns unchanged."""
    whole = free_name(docs, "_row")
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.col("doc_id"), fingerprint("text").alias("mark")
    )
    joined = join_on(held, _removed(docs), KEYS, "left", NULL_ID)
    text, lines = F.col(whole)["text"], free_name(joined, "lines")
    joined = joined.withColumn(lines, F.split(text, "\n"))
    left = F.when(F.col("removed").isNotNull(), _left(F.col(lines), F.col("removed"))).otherwise(text)
    return joined.select(*[(left if c == "text" else F.col(whole)[c]).alias(c) for c in docs.columns])
