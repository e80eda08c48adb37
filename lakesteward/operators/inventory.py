"""Storage inventory attribution: object listing -> path levels and owning table.

Everything but the two large-catalogue routes is a projection: the listing is
read once and never shuffled.
"""

from __future__ import annotations

import re

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import settle
from ..functions.text import or_empty
from ..sources.session import cut

LEVELS = 6
# Patterns up to this many (and this much text) are compiled into the plan.
PLAN_PATTERNS = 512
PLAN_PATTERN_CHARS = 256 * 1024
PATTERNS_PER_CASE = 64
# Plain locations up to these sizes are broadcast.
BROADCAST_LOCATIONS = 500_000
BROADCAST_LOCATION_BYTES = 64 * 1024 * 1024
BROADCAST_DEPTHS = 32
# A folder that more patterns share is no anchor.
ANCHOR_PATTERNS = 64
# Characters of the pieces by which patterns without a whole folder are looked up.
GRAM = 5

# Unicode case folding and "\n" as the only line end.
_PATTERN_FLAGS = "(?iud)"

# Dotless i and dotted capital I, and what stands for them in a search.
_OWN_LETTERS = ("\u0131\u0130", "\ue000\ue001")

# ASCII text without pattern signs other than the dot.
_PLAIN_TEXT = re.compile(r"^[A-Za-z0-9/_=:,@%~#&;<>! .-]*\Z")

LEVEL_COLUMNS = [f"extend_level{k}_name" for k in range(LEVELS + 1)]
SLIM_COLUMNS = [
    "name", "path_level", *LEVEL_COLUMNS, "table_name", "db_name", "tbl_name", "type", "size",
]
OWNER_COLUMNS = ("table_name", "db_name", "tbl_name", "is_table")
FULL_COLUMNS = [
    *SLIM_COLUMNS, "atime", "mtime", "ctime", "acl", "user", "group", "is_table", "dt",
]


def _is_good() -> Column:
    """Rows that can be attributed. Cheap and on plain columns, so it reaches the scan."""
    return F.coalesce(F.contains("name", F.lit("/")) & F.col("type").isin("FILE", "DIR"), F.lit(False))


def _with_parts(listing: DataFrame) -> DataFrame:
    """Good rows with the split path, its size and the deepest level that is shown.

    A FILE row leaves its last part out and stops at level 5.
    """
    good = listing.where(_is_good()).withColumn("_parts", F.split("name", "/"))
    good = good.withColumn("_n", F.size("_parts"))
    deepest = F.when(F.col("type") == "DIR", F.col("_n") - 1).otherwise(F.least(F.col("_n") - 2, F.lit(LEVELS - 1)))
    return good.withColumn("_deepest", deepest)


def _part(k: int) -> Column:
    return F.get("_parts", F.lit(k))


def path_level_columns() -> list[Column]:
    """Path depth and level names."""
    root = (F.col("_n") == 2) & (_part(1) == "")
    return [
        F.when(root, 0).otherwise(F.col("_n") - 1).cast("int").alias("path_level"),
        F.lit("/").alias(LEVEL_COLUMNS[0]),
        *[
            F.when(F.col("_deepest") >= k, _part(k)).otherwise("").alias(LEVEL_COLUMNS[k])
            for k in range(1, LEVELS + 1)
        ],
    ]


def _with_convention(good: DataFrame) -> DataFrame:
    """Owner by naming convention: a ``.db`` folder at level 4 with a table folder below."""
    folder = good.withColumn("_folder", F.when(F.col("_n") > 5, F.lower(_part(4))))
    owned = F.contains("_folder", F.lit(".db"))
    return folder.withColumns({
        "_db": F.when(owned, F.replace("_folder", F.lit(".db"), F.lit(""))),
        "_tbl": F.when(owned, F.lower(_part(5))),
    })


def convention_columns() -> list[Column]:
    return [
        or_empty(F.concat("_db", F.lit("."), "_tbl")).alias("table_name"),
        or_empty(F.col("_db")).alias("db_name"),
        or_empty(F.col("_tbl")).alias("tbl_name"),
    ]


def type_columns() -> list[Column]:
    code = F.when(F.col("type") == "FILE", 2).when(F.col("type") == "DIR", 1)
    return [
        code.cast("int").alias("type"),
        F.coalesce(F.col("size_byte"), F.lit(0)).cast("bigint").alias("size"),
    ]


def inventory_levels(listing: DataFrame) -> DataFrame:
    return _with_parts(listing).select("name", "type", *path_level_columns())


def convention_table(listing: DataFrame) -> DataFrame:
    return _with_convention(_with_parts(listing)).select("name", *convention_columns())


def type_codes(listing: DataFrame) -> DataFrame:
    return listing.where(_is_good()).select("name", *type_columns())


def inventory_rejects(listing: DataFrame) -> DataFrame:
    """Rows that cannot be attributed: no separator in the path, or another type."""
    reason = F.when(F.contains(or_empty(F.col("name")), F.lit("/")), "type").otherwise("path")
    return listing.where(~_is_good()).select("name", "type", "size_byte", "dt", reason.alias("reject_reason"))


def inventory_slim(listing: DataFrame) -> DataFrame:
    good = _with_convention(_with_parts(listing))
    return good.select(
        "name", *path_level_columns(), *convention_columns(), *type_columns()
    ).select(*SLIM_COLUMNS)


def inventory_full(listing: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    """All attribution columns; ``locations`` (pattern, table_name) overrides the convention."""
    if locations is None:
        matched = listing.withColumn("_table", F.lit(None).cast("string"))
    else:
        matched = attach_pattern_owner(listing, locations)
    owned = _owned(matched).select(
        "name", *path_level_columns(), *_owner_columns(), *type_columns(),
        *[or_empty(F.col(c)).alias(c) for c in ("atime", "mtime", "ctime", "acl", "user", "group")],
        F.try_to_date("dt", "yyyy-MM-dd").alias("dt"),
    )
    return settle(owned, OWNER_COLUMNS).select(*FULL_COLUMNS)


def match_locations(listing: DataFrame, locations: DataFrame, plan_patterns: int = PLAN_PATTERNS) -> DataFrame:
    """Owning table of every row by pattern search, with the convention as fallback."""
    return settle(_owned(attach_pattern_owner(listing, locations, plan_patterns)).select("name", *_owner_columns()), OWNER_COLUMNS)


def match_location_prefixes(listing: DataFrame, locations: DataFrame, broadcast_locations: int = BROADCAST_LOCATIONS) -> DataFrame:
    """Same, with the locations read as plain folders and matched on whole path segments."""
    return _owned(attach_prefix_owner(listing, locations, broadcast_locations)).select("name", *_owner_columns())


def _owned(matched: DataFrame) -> DataFrame:
    return _with_convention(_with_parts(matched))


def _owner_columns() -> list[Column]:
    """A known location overrides the convention; its names keep their case."""
    known = F.col("_table").isNotNull()
    target = F.split("_table", "\\.")
    by_location = {"table_name": F.col("_table"), "db_name": F.get(target, F.lit(0)), "tbl_name": F.get(target, F.lit(1))}
    columns = [
        F.when(known, by_location[c]).otherwise(fallback).alias(c)
        for c, fallback in zip(by_location, convention_columns())
    ]
    return [*columns, known.alias("is_table")]


# --- location patterns -------------------------------------------------------

def usable_locations(locations: DataFrame) -> DataFrame:
    """One target per pattern; a target without a dot names no table and is left out."""
    usable = locations.where(F.col("pattern").isNotNull() & F.col("table_name").contains("."))
    return usable.groupBy("pattern").agg(F.min("table_name").alias("table_name"))


def bad_patterns(locations: DataFrame) -> DataFrame:
    """``pattern`` of the usable locations whose pattern does not compile.

    Text without pattern signs always does. The others pass the driver one by one.
    """
    spark = locations.sparkSession
    signed = usable_locations(locations).where(~F.col("pattern").rlike(_PLAIN_TEXT.pattern)).select("pattern")
    compile_pattern = spark._jvm.java.util.regex.Pattern.compile
    bad = []
    for row in signed.toLocalIterator():
        try:
            compile_pattern(_PATTERN_FLAGS + row["pattern"])
        except IllegalArgumentException:
            bad.append((row["pattern"],))
    return spark.createDataFrame(bad, "pattern string")


def unusable_locations(locations: DataFrame) -> DataFrame:
    """Locations without a pattern or a named table, and those whose pattern does not compile."""
    named = F.coalesce(F.col("pattern").isNotNull() & F.col("table_name").contains("."), F.lit(False))
    return locations.where(~named).unionByName(locations.where(named).join(bad_patterns(locations), "pattern", "left_semi"))


def attach_pattern_owner(
    listing: DataFrame, locations: DataFrame, plan_patterns: int = PLAN_PATTERNS
) -> DataFrame:
    """Adds ``_table``: target of the longest pattern found in the path (ties: first by text).

    Patterns that do not compile are left out (see ``unusable_locations``). A small catalogue becomes constant patterns in the
    plan, each compiled once per task, and the listing is not shuffled. In a larger one, patterns meet the paths
    that hold one of their folders. Both ways give the same rows.
    """
    usable = cut(usable_locations(locations).join(bad_patterns(locations), "pattern", "left_anti"))
    head = usable.limit(plan_patterns + 1).collect()
    if len(head) <= plan_patterns and sum(len(r["pattern"]) + len(r["table_name"]) for r in head) <= PLAN_PATTERN_CHARS:
        named = listing.withColumn("_folded", _folded(F.col("name")))
        return named.withColumn("_table", _best_constant(head, F.col("name"))["table_name"]).drop("_folded")
    return _pattern_owner_joined(listing, usable, plan_patterns)


def _best_constant(rows: list, name: Column) -> Column:
    """Best of some patterns as (rank, pattern, table_name); needs a column ``_folded``."""
    kind = "struct<rank:int,pattern:string,table_name:string>"
    known = sorted(rows, key=lambda r: (-len(r["pattern"]), r["pattern"]))
    groups = []
    for start in range(0, len(known), PATTERNS_PER_CASE):
        case = None
        for row in known[start:start + PATTERNS_PER_CASE]:
            add = F.when if case is None else case.when
            entry = F.struct(F.lit(-len(row["pattern"])).alias("rank"), F.lit(row["pattern"]).alias("pattern"), F.lit(row["table_name"]).alias("table_name"))
            case = add(_found(row["pattern"], name), entry)
        groups.append(case)
    return F.coalesce(*groups) if groups else F.lit(None).cast(kind)


def _searched(name: Column | str) -> Column:
    """Path as patterns see it.

    The engine would take the dotless i and the dotted capital I for an i; as other characters they are only themselves.
    """
    return F.translate(or_empty(F.col(name) if isinstance(name, str) else name), *_OWN_LETTERS)


def _folded(name: Column) -> Column:
    """Path in lower case; the long s and the Kelvin sign are the only letters beyond ASCII that fold to ASCII ones."""
    return F.replace(F.lower(_searched(name)), F.lit("\u017f"), F.lit("s"))


def _found(pattern: str, name: Column) -> Column:
    """Is the pattern found in the path?

    Text that holds no pattern signs is looked up as text. Where the only sign is
    a dot, the longest text between dots must be there before the pattern is tried.
    """
    search = _searched(name).rlike(_PATTERN_FLAGS + pattern.translate(str.maketrans(*_OWN_LETTERS)))
    if not _PLAIN_TEXT.match(pattern):
        return search
    pieces = pattern.lower().split(".")
    held = F.contains("_folded", F.lit(max(pieces, key=len)))
    return held if len(pieces) == 1 else held & search


def _pattern_owner_joined(listing: DataFrame, usable: DataFrame, plan_patterns: int) -> DataFrame:
    """Pattern search for any number of patterns.

    A pattern of plain text and dots can only be found in a path that has each of its inner folders (those
    between two slashes). The folder that the fewest patterns share is its anchor; distinct paths meet patterns by
    anchor in an equi-join and the pattern is tried on these pairs. Patterns of plain text without an anchor that at most
    ANCHOR_PATTERNS share are looked up by their rarest piece of GRAM characters (see ``gram_pairs``). What is left, patterns with other signs
    or with shorter texts only, is tried on all distinct paths, plan_patterns at a time.
    """
    plain = usable.where(F.col("pattern").rlike(_PLAIN_TEXT.pattern))
    pieces = F.split(F.lower("pattern"), "/")
    inner = F.filter(F.slice(pieces, 2, F.greatest(F.size(pieces) - 2, F.lit(0))), lambda p: (p != "") & ~p.contains("."))
    folders = cut(plain.select("pattern", "table_name", F.explode(F.array_distinct(inner)).alias("_folder")))
    shared = cut(folders.groupBy("_folder").agg(F.count("*").alias("_shared")).where(F.col("_shared") <= ANCHOR_PATTERNS))
    ranked = folders.join(shared, "_folder").groupBy("pattern", "table_name").agg(
        F.min(F.struct("_shared", (-F.length("_folder")).alias("_size"), "_folder"))["_folder"].alias("_folder")
    )
    anchored = cut(ranked)
    names = listing.select(or_empty(F.col("name")).alias("_name")).distinct().withColumn("_folded", _folded(F.col("_name")))
    names = cut(names)
    held = names.select("_name", F.explode(F.array_distinct(F.split("_folded", "/"))).alias("_folder"))
    regex = F.concat(F.lit(_PATTERN_FLAGS), F.col("pattern"))
    loose = cut(plain.join(anchored.select("pattern"), "pattern", "left_anti").where(F.size(_text_grams()) > 0))
    pairs = held.join(anchored, "_folder").select("_name", "pattern", "table_name")
    pairs = pairs.unionByName(gram_pairs(names, loose).select("_name", "pattern", "table_name"))
    met = pairs.where(F.regexp_like(_searched("_name"), regex))
    anchored = anchored.select("pattern").unionByName(loose.select("pattern"))
    best = met.select("_name", F.struct((-F.length("pattern")).alias("rank"), "pattern", "table_name").alias("_best"))

    block: list = []

    def tried(rows: list) -> DataFrame:
        return names.select("_name", _best_constant(rows, F.col("_name")).alias("_best")).where("_best is not null")

    for row in usable.join(anchored.select("pattern"), "pattern", "left_anti").toLocalIterator():
        block.append(row)
        if len(block) >= max(1, plan_patterns):
            best = best.unionByName(tried(block))
            block = []
    if block:
        best = best.unionByName(tried(block))
    owners = best.groupBy("_name").agg(F.min("_best")["table_name"].alias("_table"))
    return _attach_by_name(listing, owners)


def _grams(text: Column) -> Column:
    """All pieces of GRAM characters of a text."""
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    return F.when(F.length(text) >= GRAM, F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))).otherwise(F.array().cast("array<string>"))


def _text_grams() -> Column:
    """The pieces of a plain pattern's texts, which any path it is found in must hold."""
    return F.array_distinct(F.flatten(F.transform(F.split(F.lower("pattern"), "\\."), _grams)))


def _bounded(df: DataFrame) -> DataFrame:
    """A written table of texts, to be broadcast if it is as small as a catalogue that is. One aggregate measures it; before a shuffle the engine cannot tell."""
    texts = [F.octet_length(f.name) for f in df.schema if f.dataType.simpleString() == "string"]
    measured = df.agg(F.count("*").alias("rows"), F.sum(sum(texts, F.lit(0))).alias("bytes")).first()
    small = measured["rows"] <= BROADCAST_LOCATIONS and (measured["bytes"] or 0) <= BROADCAST_LOCATION_BYTES
    return F.broadcast(df) if small else df


def gram_pairs(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """Paths (``_name``, ``_folded``) with the plain patterns (``pattern``, ``table_name``) that may be found in them.

    A pattern meets the paths that hold the one of its pieces that the fewest paths hold, counted over all paths; a pattern
    with a piece that no path holds meets none. Those are most of a large catalogue, so they go first, by counts alone.
    """
    def pieces(of: DataFrame) -> DataFrame:
        return of.select("pattern", "table_name", F.explode(_text_grams()).alias("_gram"))

    held = names.select("_name", F.explode(F.array_distinct(_grams(F.col("_folded")))).alias("_gram"))
    often = _bounded(cut(held.groupBy("_gram").agg(F.count("*").alias("_paths"))))
    counted = pieces(patterns).join(often, "_gram", "left").groupBy("pattern", "table_name")
    whole = cut(counted.agg(F.count("*").alias("_all"), F.count("_paths").alias("_held")).where("_all = _held").select("pattern", "table_name"))
    rarest = pieces(whole).join(often, "_gram").groupBy("pattern", "table_name").agg(F.min(F.struct("_paths", "_gram")).alias("_rarest"))
    anchors = _bounded(cut(rarest.select("pattern", "table_name", F.col("_rarest._gram").alias("_gram"))))
    return held.join(anchors, "_gram")


def _attach_by_name(listing: DataFrame, owners: DataFrame) -> DataFrame:
    """Left join of one owner per path.

    The owners are written first: few enough of them are broadcast, and the listing is not shuffled. Otherwise both sides of the join are plain
    shuffles, and the engine splits a path that fills much of the listing.
    """
    named = listing.withColumn("_name", or_empty(F.col("name")))
    return named.join(_bounded(cut(owners)), "_name", "left").drop("_name")


# --- plain locations ---------------------------------------------------------

def attach_prefix_owner(
    listing: DataFrame, locations: DataFrame, broadcast_locations: int = BROADCAST_LOCATIONS
) -> DataFrame:
    """Adds ``_table``: target of the deepest location that is a parent of, or equals, the path.

    One aggregate measures the catalogue. A bounded one is broadcast, one
    hash join per folder depth, and the listing is not shuffled. Otherwise the
    parents of the distinct paths are joined with the locations by key.
    """
    usable = (
        usable_locations(locations)
        .select(F.lower(F.rtrim(F.col("pattern"), F.lit("/"))).alias("_loc"), F.col("table_name").alias("_target"))
        .where("_loc <> ''")
        .groupBy("_loc")
        .agg(F.min("_target").alias("_target"))
        .withColumn("_depth", F.size(F.split("_loc", "/")))
    )
    # Written once, since it is read for the measure and then once per depth.
    usable = cut(usable)
    measured = usable.agg(
        F.count("*").alias("rows"),
        F.sum(F.octet_length("_loc") + F.octet_length("_target")).alias("bytes"),
        F.array_sort(F.collect_set("_depth")).alias("depths"),
    ).first()
    bounded = (
        measured["rows"] <= broadcast_locations
        and (measured["bytes"] or 0) <= BROADCAST_LOCATION_BYTES
        and len(measured["depths"]) <= BROADCAST_DEPTHS
    )
    if not bounded:
        return _prefix_owner_joined(listing, usable, measured["depths"])
    out = listing.withColumn("_path", F.split(F.lower(or_empty(F.col("name"))), "/"))
    found = []
    for depth in reversed(measured["depths"]):
        here = usable.where(F.col("_depth") == depth).select(
            F.col("_loc").alias(f"_loc{depth}"), F.col("_target").alias(f"_target{depth}")
        )
        parent = F.when(F.size("_path") >= depth, F.array_join(F.slice("_path", 1, depth), "/"))
        out = out.join(F.broadcast(here), parent == F.col(f"_loc{depth}"), "left").drop(f"_loc{depth}")
        found.append(F.col(f"_target{depth}"))
    table = F.coalesce(*found) if found else F.lit(None).cast("string")
    out = out.withColumn("_table", table)
    return out.drop("_path", *[f"_target{d}" for d in measured["depths"]])


def _prefix_owner_joined(listing: DataFrame, usable: DataFrame, depths: list[int]) -> DataFrame:
    """Prefix search for a catalogue of any size, by an equi-join on the parent folders of the depths that occur in it."""
    names = listing.select(or_empty(F.col("name")).alias("_name")).distinct()
    path = F.split(F.lower(F.col("_name")), "/")
    at = F.filter(F.array(*[F.lit(d) for d in depths]), lambda d: d <= F.size(path))
    parents = names.withColumn("_loc", F.explode(F.transform(at, lambda d: F.array_join(F.slice(path, 1, d), "/"))))
    best = parents.where("_loc <> ''").join(usable, "_loc").groupBy("_name").agg(F.max_by("_target", "_depth").alias("_table"))
    return _attach_by_name(listing, best)


def storage_per_table(inventory: DataFrame) -> DataFrame:
    """Bytes and objects of each owning table."""
    grouped = inventory.groupBy("db_name", "tbl_name").agg(
        F.sum("size").alias("total_size"), F.count("*").alias("objects")
    )
    return grouped.orderBy(F.desc("total_size"), "db_name", "tbl_name")
