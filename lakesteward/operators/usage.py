"""Query log -> tables each statement uses.

A text scan by pattern, not a parser: every step is a column expression, so the
log is read once, never shuffled, and the same code runs on a stream. All
repeated groups in the patterns are possessive, because the JVM's regex engine
recurses on plain ones and long statements would exhaust the stack. No pattern
reads on to the end of the text from each of many openings that nothing closes, so
the time grows with the length of a statement and not with its square.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import list_drop_matching
from ..functions.rows import unnest, unnest_placed
from ..functions.text import bind, or_empty, trim_ws

DEFAULT_CATALOG = "default_catalog"
# Names that are never tables, and marks of names to leave out.
IGNORED_TABLES = ("dual", "unnest", "files", "generate_series")
IGNORED_SIGNS = ("#tableau_",)

_S = r"[ \t\n\f\r]"
_WORD = r"[a-z0-9_\p{L}]"
_IDENT = rf"(?:{_WORD}++|`[^`]++`)"
_NAME = rf"{_IDENT}(?:{_S}*+\.{_S}*+{_IDENT})*+"
_START = rf"(?:^|{_S}|\\n)"
# After a keyword: blanks, or a backquoted name at once.
_GAP = rf"(?:{_S}++|(?=`))"
_KIND = rf"(?:table|view|materialized{_S}++view)"
_ALIAS = rf"(?:{_S}++as(?!{_WORD}))?+(?:{_S}++{_WORD}++|{_S}*+`[^`]++`)?+"

_PATTERNS = {
    "FROM": rf"(?i){_START}from{_GAP}({_NAME})",
    "JOIN": rf"(?i){_START}join{_GAP}({_NAME})",
    "WITH": rf"(?i)(?:with{_GAP}|,{_S}*+)({_IDENT})(?:{_S}*+\([^()]++\))?+{_S}++as{_S}*+\(",
    # What stands in the brackets; the name after its last FROM is taken in a second step.
    "EXTRACT TIME": rf"(?i)extract{_S}*+\(((?:[^)`]++|`[^`]++`|`)++)",
    "INSERT": rf"(?i)insert{_S}++(?:into|overwrite){_GAP}({_NAME})",
    "CREATE": rf"(?i)create{_S}++{_KIND}(?:{_S}++if{_S}++not{_S}++exists)?{_GAP}({_NAME})",
    "DROP": rf"(?i)drop{_S}++(?:temporary{_S}++)?+{_KIND}(?:{_S}++if{_S}++exists)?{_GAP}({_NAME})",
    "ALTER": rf"(?i){_START}alter{_S}++{_KIND}{_GAP}({_NAME})",
    "UPDATE": rf"(?i){_START}update{_GAP}({_NAME})",
    "DELETE": rf"(?i){_START}delete{_S}++from{_GAP}({_NAME})",
    "TRUNCATE": rf"(?i){_START}truncate{_S}++table{_GAP}({_NAME})",
}
# A text without one of these words cannot hold the action, so its pattern is not tried.
_NEEDLES = {
    "FROM": ["from"], "JOIN": ["join"], "WITH": ["as", "("], "EXTRACT TIME": ["extract"], "INSERT": ["insert"],
    "CREATE": ["create"], "DROP": ["drop"], "ALTER": ["alter"], "UPDATE": ["update"], "DELETE": ["delete"],
    "TRUNCATE": ["truncate"],
}
_LAST_FROM = rf"(?is)^.+from{_GAP}({_NAME})"
# Second and later names of a comma list after FROM.
_COMMA_LIST = rf"(?i){_START}from{_GAP}{_NAME}{_ALIAS}((?:{_S}*+,{_S}*+{_NAME}{_ALIAS})++)"
_LISTED = rf"(?i),{_S}*+({_NAME})"
# One part of a name, with the dot before it.
_PART = rf"(?:{_S}*+\.{_S}*+)?+(?:`([^`]++)`|([0-9_\p{{L}}]++))"

_SET = rf"(?i){_START}set{_S}++catalog{_GAP}({_IDENT})"
_USE = rf"(?i){_START}use{_GAP}({_IDENT}(?:{_S}*+\.{_S}*+{_IDENT})?+)"

# Stands for a literal until open quotes are back; statements hold no such character.
_MARK = "\x00"

ACTIONS_OUT = ("DELETE", "SELECT", "ALTER", "CREATE", "DROP", "INSERT", "UPDATE", "TRUNCATE")


# --- text and session --------------------------------------------------------

def default_catalog(catalog: Column, default: str | None = None) -> Column:
    """Catalog, or the default where it is blank."""
    blank = F.replace(or_empty(catalog), F.lit(" "), F.lit("")) == ""
    return F.when(blank, F.lit(default or DEFAULT_CATALOG)).otherwise(catalog)


def _replaced(text: Column, needles: Sequence[str], pattern: str, new: str = " ") -> Column:
    """Pattern replacement, skipped for texts that lack one of the needles."""
    def step(t: Column) -> Column:
        held = F.contains(t, F.lit(needles[0]))
        for needle in needles[1:]:
            held = held & F.contains(t, F.lit(needle))
        return F.when(held, F.regexp_replace(t, pattern, new)).otherwise(t)

    return bind(text, step)


def _without_blank_lines(text: Column) -> Column:
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda line: trim_ws(line) != ""), "\n")
    return F.when(F.contains(text, F.lit("\n")), kept).when(trim_ws(text) == "", "").otherwise(text)


def _without_literals(text: Column, quote: str, stop: str = "") -> Column:
    """Quoted literals as blanks; ``stop`` is what a literal cannot cross.

    A quote that nothing closes is passed over with all it would hold, so that what is in it is not tried again.
    """
    inner = rf"[^\\{quote}{stop}]*+(?:\\[^\n][^\\{quote}{stop}]*+)*+"
    marked = _replaced(text, [quote], rf"{quote}{inner}{quote}|({quote}{inner})", f"{_MARK}$1")
    return F.replace(F.replace(marked, F.lit(_MARK + quote), F.lit(quote)), F.lit(_MARK), F.lit(" "))


def _without_comments(text: Column) -> Column:
    """Block comments as line ends. Behind the last comment end no opening is tried, for none can close."""
    tail = F.substring_index(text, "*/", -1)
    head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
    cleaned = F.concat(F.regexp_replace(head, r"(?s)/\*.*?\*/", "\n"), tail)
    return F.when(F.contains(text, F.lit("/*")) & F.contains(text, F.lit("*/")), cleaned).otherwise(text)


def clean_text(query: Column, drop_literals: bool = True) -> Column:
    """Statement without comments, blank lines and (on request) quoted literals."""
    text = F.replace(or_empty(query), F.lit("\\n"), F.lit("\n"))
    text = bind(text, _without_comments)
    if drop_literals:
        text = _without_literals(_without_literals(text, "'", "\\n"), '"', "\\n")
    text = _replaced(text, ["--"], r"--[^\n]*+")
    text = bind(text, _without_blank_lines)
    if drop_literals:
        text = _without_literals(_without_literals(text, "'"), '"')
    return text


def _name_parts(canonical: Column) -> Column:
    """Parts of a canonical name; a list of one empty text for an empty name."""
    return F.split(F.substring(canonical, F.lit(2), F.length(canonical) - 2), "`\\.`")


def _with_session(log: DataFrame, default: str | None) -> DataFrame:
    """Adds the cleaned text and the session the statement runs in.

    Only a text with at least two statements can change its session; the last
    SET CATALOG or USE counts for the whole text.
    """
    log = _with_clean(log).withColumn("_statements", F.split("clean_query", ";"))
    steps = F.transform(
        "_statements",
        lambda s: F.struct(
            canonical_name(F.regexp_extract(s, _SET, 1)).alias("set"),
            canonical_name(F.regexp_extract(s, _USE, 1)).alias("use"),
        ),
    )
    none = F.array().cast("array<struct<set:string,use:string>>")
    log = log.withColumn("_steps", F.when(F.size("_statements") >= 2, steps).otherwise(none))

    # A list of the catalogs that are set, in order: within a statement SET comes first, then USE.
    def catalogs_of(step: Column) -> Column:
        used = F.when(F.contains(step["use"], F.lit("`.`")), F.substring_index(step["use"], ".`", 1))
        return F.array(F.nullif(step["set"], F.lit("")), used)

    catalogs = F.array_compact(F.flatten(F.transform("_steps", catalogs_of)))
    schemas = F.filter(F.transform("_steps", lambda s: F.substring_index(s["use"], "`.", -1)), lambda u: u != "")
    start = default_catalog(F.col("catalog"), default)
    last = {
        "session_catalog": F.coalesce(F.try_element_at(catalogs, F.lit(-1)), start),
        "session_db": F.coalesce(F.try_element_at(schemas, F.lit(-1)), or_empty(F.col("db_name"))),
    }
    bare = {name: F.replace(value, F.lit("`"), F.lit("")) for name, value in last.items()}
    return log.withColumns(bare).drop("_statements", "_steps")


# --- names -------------------------------------------------------------------

def canonical_name(name: Column) -> Column:
    """Lower-cased name with every part in backquotes: ``A . `b c` `` -> `` `a`.`b c` ``."""
    return F.rtrim(F.regexp_replace(F.lower(name), _PART, "`$1$2`."), F.lit("."))


def _canonical(names: Column) -> Column:
    return F.array_distinct(F.transform(names, canonical_name))


def _guarded(text: Column, lower: Column, needles: Sequence[str], pattern: str) -> Column:
    """All matches of a pattern, tried only on texts that hold every needle."""
    held = F.lit(True)
    for needle in needles:
        held = held & F.contains(lower, F.lit(needle))
    return F.when(held, F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(
        F.array().cast("array<string>")
    )


def table_names(action: str, text: Column, lower: Column, signs: Sequence[str] = ()) -> Column:
    """Names one action finds in a cleaned text: canonical, distinct, first occurrence first.

    ``lower`` is the text in lower case.
    """
    found = _guarded(text, lower, _NEEDLES[action], _PATTERNS[action])
    if action == "JOIN":
        lists = _guarded(text, lower, ["from", ","], _COMMA_LIST)
        listed = F.flatten(F.transform(lists, lambda t: F.regexp_extract_all(t, F.lit(_LISTED), F.lit(1))))
        found = F.concat(listed, found)
    if action == "EXTRACT TIME":
        last = F.transform(found, lambda t: F.regexp_extract(t, _LAST_FROM, 1))
        found = F.filter(last, lambda name: name != "")
    names = _canonical(found)
    return list_drop_matching(names, [s.lower() for s in signs]) if signs else names


def ignored_names(extra: Sequence[str] = ()) -> Column:
    """Canonical names on the ignore list, the fixed ones and the caller's, as constants."""
    listed = [re.findall(r"`[^`]+`|\w+", n.lower()) for n in (*IGNORED_TABLES, *extra)]
    return F.array(*[F.lit(".".join(f"`{p.strip('`')}`" for p in parts)) for parts in listed])


def _with_clean(log: DataFrame) -> DataFrame:
    return log.withColumn("clean_query", clean_text(F.col("query"))).withColumn("_lower", F.lower("clean_query"))


def _with_names(
    log: DataFrame, ignore_tables: Sequence[str], ignore_signs: Sequence[str], actions: Sequence[str] = tuple(_PATTERNS)
) -> DataFrame:
    """Adds a name list per action, and the names read from: FROM and JOIN without the rest."""
    signs = [*IGNORED_SIGNS, *ignore_signs]
    text, lower = F.col("clean_query"), F.col("_lower")
    log = log.withColumns({f"_{a}": table_names(a, text, lower, signs if a == "DROP" else ()) for a in actions})
    excluded = F.concat("`_EXTRACT TIME`", "_WITH", "_DELETE", ignored_names(ignore_tables))
    return log.withColumn("_SELECT", F.array_except(F.array_union("_FROM", "_JOIN"), excluded))


def analyse_log(
    log: DataFrame,
    default: str | None = None,
    ignore_tables: Sequence[str] = (),
    ignore_signs: Sequence[str] = (),
) -> DataFrame:
    """Log with the cleaned text, the session and the name list of every action."""
    return _with_names(_with_session(log, default), ignore_tables, ignore_signs)


def _part_count(name: Column) -> Column:
    """Parts of a canonical name; only separators hold a backquote, a dot and a backquote."""
    separators = F.length(name) - F.length(F.replace(name, F.lit("`.`"), F.lit("")))
    return (separators / F.lit(3)).cast("int") + 1


def _usable(name: Column) -> Column:
    """Can the name be qualified? It needs one to three parts, and a database to put a bare name in."""
    fewest = F.when(F.col("session_db") == "", 2).otherwise(1)
    return _part_count(name).between(fewest, F.lit(3))


def _exploded(analysed: DataFrame, actions: Sequence[str], usable: bool | None) -> DataFrame:
    """One row per name of the actions, by a single explode of their joined lists.

    The place in the joined list tells the action and the index within it, so the
    elements stay plain text; the rest is worked out per row after the explode.
    Unusable names take no index, so their places are kept beside the list.
    """
    joined = F.concat(*[F.col(f"_{a}") for a in actions])
    unusable = F.array_compact(F.transform(joined, lambda n, i: F.when(~_usable(n), i)))
    ends, end = {}, F.lit(0)
    for name in actions:
        end = end + F.size(f"_{name}")
        ends[f"_end_{name}"] = end
    sized = analysed.withColumns({"_unusable": unusable, **ends})
    rows = unnest_placed(sized, joined, "_at", "name", "query_id", "session_catalog", "session_db", "_unusable", *ends)
    action, start, begin = None, None, F.lit(0)
    for name in actions:
        within = F.col("_at") < F.col(f"_end_{name}")
        action = F.when(within, name) if action is None else action.when(within, name)
        start = F.when(within, begin) if start is None else start.when(within, begin)
        begin = F.col(f"_end_{name}")
    rows = rows.withColumns({
        "action": action, "_start": start, "_parts": _name_parts(F.col("name")), "_ok": _usable(F.col("name")),
    })
    if usable is not None:
        rows = rows.where(F.col("_ok") == F.lit(usable))
    skipped = F.filter("_unusable", lambda p: (p >= F.col("_start")) & (p < F.col("_at")))
    count = F.size("_parts")
    target = {
        "catalog": F.when(count == 3, F.get("_parts", F.lit(0))).otherwise(F.col("session_catalog")),
        "db_name": F.when(count == 1, F.col("session_db")).otherwise(F.get("_parts", count - 2)),
        "table_name": F.get("_parts", count - 1),
    }
    return rows.select(
        "query_id", "action", "name",
        *[F.when(F.col("_ok"), value).alias(column) for column, value in target.items()],
        (F.col("_at") - F.col("_start") - F.size(skipped)).alias("index"),
    )


def log_usage(
    log: DataFrame,
    default: str | None = None,
    ignore_tables: Sequence[str] = (),
    ignore_signs: Sequence[str] = (),
    actions: Sequence[str] = ACTIONS_OUT,
) -> DataFrame:
    """One row per used table: query_id, action, catalog, db_name, table_name, index within the action."""
    analysed = analyse_log(log, default, ignore_tables, ignore_signs)
    return _exploded(analysed, actions, True).drop("name")


def log_errors(log: DataFrame, **options) -> DataFrame:
    """Names that cannot be qualified: too many parts, or no database to put them in."""
    actions = options.pop("actions", ACTIONS_OUT)
    return _exploded(analyse_log(log, **options), actions, False).select("query_id", "action", "name")


def log_qualified(log: DataFrame, **options) -> DataFrame:
    """Every name with its parts, or with ``is_error`` set: both outcomes in one pass."""
    actions = options.pop("actions", ACTIONS_OUT)
    rows = _exploded(analyse_log(log, **options), actions, None).drop("index")
    is_error = F.col("table_name").isNull()
    parts = {c: or_empty(F.col(c)) for c in ("catalog", "db_name", "table_name")}
    return rows.withColumns({"is_error": is_error, **parts})


# --- single steps ------------------------------------------------------------

def log_default_catalog(log: DataFrame, default: str | None = None) -> DataFrame:
    return log.select("query_id", default_catalog(F.col("catalog"), default).alias("catalog"))


def log_clean(log: DataFrame, drop_literals: bool = True) -> DataFrame:
    return log.select("query_id", clean_text(F.col("query"), drop_literals).alias("clean_query"))


def log_session(log: DataFrame, default: str | None = None) -> DataFrame:
    return _with_session(log, default).select("query_id", "session_catalog", "session_db")


def log_names(log: DataFrame, action: str, ignore_signs: Sequence[str] = ()) -> DataFrame:
    """One row per name an action finds, with its place in the statement."""
    signs = [*IGNORED_SIGNS, *ignore_signs] if action == "DROP" else ()
    names = table_names(action, F.col("clean_query"), F.col("_lower"), signs)
    return unnest_placed(_with_clean(log), names, "place", "name", "query_id")


_READ_STEPS = ("FROM", "JOIN", "EXTRACT TIME", "WITH", "DELETE")


def log_select(log: DataFrame, ignore_tables: Sequence[str] = ()) -> DataFrame:
    """Names read by each statement, before they are qualified."""
    named = _with_names(_with_clean(log), ignore_tables, (), _READ_STEPS)
    return unnest_placed(named, F.col("_SELECT"), "place", "name", "query_id")


def log_ignored(log: DataFrame, ignore_tables: Sequence[str] = (), ignore_signs: Sequence[str] = ()) -> DataFrame:
    """Names that the ignore lists take out: listed tables, and dropped tables with a sign."""
    text, lower = F.col("clean_query"), F.col("_lower")
    read = F.array_union(table_names("FROM", text, lower), table_names("JOIN", text, lower))
    listed = F.array_intersect(read, ignored_names(ignore_tables))
    signs = [s.lower() for s in (*IGNORED_SIGNS, *ignore_signs)]
    signed = bind(table_names("DROP", text, lower), lambda d: F.array_except(d, list_drop_matching(d, signs)))
    tagged = F.concat(
        F.transform(listed, lambda n: F.struct(F.lit("table").alias("list"), n.alias("name"))),
        F.transform(signed, lambda n: F.struct(F.lit("sign").alias("list"), n.alias("name"))),
    )
    return unnest(_with_clean(log), tagged, "e").select("query_id", "e.*")
