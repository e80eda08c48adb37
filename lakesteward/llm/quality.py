"""Quality rules: a threshold table compiled into one projection over length, symbol, stop-word and line ratios.

Defined results: a null text counts as empty and fails the base rules; repeated
rows and equal texts get equal verdicts; an empty table gives an empty result;
other columns are ignored by ``quality_metrics`` and returned untouched by
``quality_filter``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rows import keep_where
from .tables import BLANKS, free_name, text_or_empty

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Common words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for with as on be by this are was from at or an not have has "
    "der die das und ist in zu den von mit sich auf für nicht ein eine des dem im "
    "le la les de des du et en un une que qui est dans par pour sur pas au avec "
    "el los las y se del con no una por su para como al lo"
)
STOP_WORDS = tuple(dict.fromkeys(STOP_WORDS.split()))
PUNCTUATION = ".,;:!?"


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high``, asked of texts with ``min_words`` words or more."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    min_words: int = 0


# Percentages. Clean prose of the labelled documents stays far inside each of them.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1200),
    Rule("symbols", "n_symbols", "n_words", None, 10),
    Rule("exclamations", "n_exclamations", "n_words", None, 30),
    Rule("capitals", "n_capitals", "word_chars", None, 40),
    Rule("stop_words", "n_stop_words", "n_words", 6, None, 50),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
)


def _repeated(hashes: str) -> tuple[Column, Column, Column]:
    """Steps from word hashes to the number of words in repeated windows: windows, flagged windows, count."""
    h = F.col(hashes)
    window = F.when(
        F.size(h) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
        ),
    )
    # Only texts that repeat a window at all pay for the sort.
    ordered = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
    )
    o = F.col("_ordered")
    same = F.filter(
        o, lambda s, k: (s["x"] == F.get(o, F.greatest(k - 1, F.lit(0)))["x"]) & (k > 0)
        | F.coalesce(s["x"] == F.get(o, k + 1)["x"], F.lit(False)),
    )
    return window, ordered, F.sort_array(F.transform(same, lambda s: s["i"]))


def _metrics(df: DataFrame, text: str) -> DataFrame:
    """Adds the measures to a table whose other columns cannot clash (see the callers)."""
    t = text_or_empty(text)
    window, ordered, flagged = _repeated("_hashes")
    places = F.col("_flagged")
    covered = F.aggregate(
        F.transform(places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0), lambda a, x: a + x,
    )
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    stop = F.filter(F.col("_words"), lambda w: F.lower(F.rtrim(w, F.lit(PUNCTUATION))).isin(*STOP_WORDS))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(t) - F.regexp_count(t, F.lit(f"[{BLANKS}]")),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_stop_words": F.size(stop),
        "n_exclamations": F.regexp_count(t, F.lit("!")),
        "n_capitals": F.regexp_count(t, F.lit(r"\p{Lu}")),
    }
    words = F.array_remove(F.split(t, f"[{BLANKS}]+"), "")
    staged = df.withColumns({"_words": words, "_lines": lines})
    staged = staged.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    for name, step in (("_windows", window), ("_ordered", ordered), ("_flagged", flagged)):
        staged = staged.withColumn(name, step)
    measured = staged.withColumns({k: v.cast("long") for k, v in counts.items()})
    return measured.drop("_words", "_lines", "_hashes", "_windows", "_ordered", "_flagged")


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def broken_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that a row of measures breaks, one projection for the whole table of rules."""
    checks = []
    for rule in rules:
        part, whole = 100 * F.col(rule.part), F.col(rule.whole)
        wrong = F.lit(False)
        if rule.low is not None:
            wrong = wrong | (part < rule.low * whole)
        if rule.high is not None:
            wrong = wrong | (part > rule.high * whole)
        checks.append(F.when(wrong & (F.col("n_words") >= rule.min_words), F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def quality_metrics(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id, measures, ``base_failed``, ``kept`` and the names of the broken rules."""
    measured = _metrics(docs.select("doc_id", F.col("text").alias("_text")), "_text").drop("_text")
    judged = measured.withColumns({"base_failed": base_failed(), "broken": broken_rules(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that every rule keeps, with their columns as they were."""
    whole = free_name(docs, "_row")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole), F.col("text").alias("_text"))
    judged = _metrics(held, "_text").withColumns({"_failed": base_failed(), "_broken": broken_rules(rules)})
    # Not a plain filter: Catalyst would copy all measures into it, many times over.
    kept = keep_where(judged, ~F.col("_failed") & (F.size("_broken") == 0))
    return kept.select(*[F.col(whole)[c].alias(c) for c in docs.columns])
