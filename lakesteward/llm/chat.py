"""Chat formatting: records of different layouts become canonical turns, then one marked text with a loss mask.

A record is a JSON text. Its nested field paths, without the types of single values, are hashed to a
fingerprint, and the fingerprint selects a declarative mapping from the table LAYOUTS. So records of
many layouts can stand in one column.

The template writes each turn as ``[INST]role[/INST]text</s>``. Inside roles and texts a backslash is doubled, and
a control string gets a backslash behind its first character, so no text can end its turn, and reading back
restores every text. The mask has one entry a turn: characters before the text, characters
of the text, and whether the text counts for the loss.

Defined results: a null or unreadable record and one of an unknown layout give null turns; a null
text is empty, a null role too; a conversation without turns gives an empty text; repeated rows are repeated
turns; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, END = "[INST]", "[/INST]", "</s>"
LOSS_ROLE = "assistant"


@dataclass(frozen=True)
class Layout:
    """A mapping for the records with the given field paths.

    Either ``turns`` lists role and path of each turn in order, or ``items`` is the path of a list of turns with
    the fields ``role`` and ``text``; ``roles`` renames roles.
    """

    name: str
    paths: str
    turns: tuple[tuple[str, str], ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: tuple[tuple[str, str], ...] = ()


LAYOUTS = (
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", items="$.messages", role="role", text="content"),
    Layout("no_messages", "OBJECT<messages: ARRAY>", items="$.messages", role="role", text="content"),
    Layout(
        "conversations", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", items="$.conversations", role="from", text="value",
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout("prompt", "OBJECT<prompt, response>", turns=(("user", "$.prompt"), ("assistant", "$.response"))),
    Layout("completion", "OBJECT<completion, prompt>", turns=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("question", "OBJECT<answer, question>", turns=(("user", "$.question"), ("assistant", "$.answer"))),
    Layout(
        "instruction", "OBJECT<input, instruction, output>",
        turns=(("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")),
    ),
    Layout("short_instruction", "OBJECT<instruction, output>", turns=(("user", "$.instruction"), ("assistant", "$.output"))),
)


def field_paths(record: Column) -> Column:
    """The nested fields of a parsed record as one text, in order of name; single values have no type in it."""
    return F.regexp_replace(
        F.schema_of_variant(record), r"(: |ARRAY<)(?:[A-Z_]+(?:\(\d+,\s*\d+\))?)(?=[,>])", "$1"
    )


def schema_fingerprint(record: Column) -> Column:
    paths = F.regexp_replace(F.regexp_replace(field_paths(record), r": (?=[,>])", ""), r"ARRAY<>", "ARRAY")
    return F.xxhash64(paths)


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _turns(layout: Layout, record: Column) -> Column:
    if layout.turns:
        return F.array(*[
            F.struct(F.lit(role).alias("role"), _text(F.try_variant_get(record, path, "string")).alias("text"))
            for role, path in layout.turns
        ])
    kind = f"array<struct<`{layout.role}`: string, `{layout.text}`: string>>"
    items = F.try_variant_get(record, layout.items, kind)

    def turn(item: Column) -> Column:
        role = _text(item[layout.role])
        for old, new in layout.roles:
            role = F.when(item[layout.role] == old, F.lit(new)).otherwise(role)
        return F.struct(role.alias("role"), _text(item[layout.text]).alias("text"))

    return F.transform(items, turn)


def canonical_turns(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``fingerprint``, ``layout`` and ``turns`` (array of role and text) to a table of JSON records."""
    parsed = records.withColumn("_record", F.try_parse_json(record))
    marked = parsed.withColumn("fingerprint", schema_fingerprint(F.col("_record")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for entry in layouts:
        # The hash of a literal is folded, so the plan compares numbers only.
        same = F.col("fingerprint") == F.xxhash64(F.lit(entry.paths))
        layout = F.when(same, F.lit(entry.name)).otherwise(layout)
        turns = F.when(same, _turns(entry, F.col("_record"))).otherwise(turns)
    return marked.withColumns({"layout": layout, "turns": turns}).drop("_record")


def unread_records(records: DataFrame, record: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records that give no turns, with ``reason``: text that is no JSON or too long for a parsed value, or a layout that no mapping covers."""
    read = canonical_turns(records.withColumn("_given", F.col(f"`{record}`")), record, layouts)
    reason = F.when(F.try_parse_json("_given").isNull(), "unreadable").otherwise("unknown layout")
    return read.where("_given is not null and turns is null").withColumn("reason", reason).select(*[f"`{c}`" for c in records.columns], "reason")


# --- template ----------------------------------------------------------------

def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), r"([\[<])(/?INST\]|/s>)", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(table: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted`` and ``mask`` (array of before, chars, loss) and drops the turns."""
    escaped = F.transform(turns, lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == LOSS_ROLE).alias("loss")))
    written = F.transform("_escaped", lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(END)))
    around = len(OPEN) + len(MIDDLE)
    mask = F.transform("_escaped", lambda t: F.struct(
        (F.length(t["role"]) + around).alias("before"), F.length(t["text"]).alias("chars"), t["loss"].alias("loss")
    ))
    out = table.withColumn("_escaped", escaped).withColumns({"formatted": F.array_join(written, ""), "mask": mask})
    return out.drop("_escaped", turns)


def read_turns(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_texts``, read from the formatted text and its mask alone."""
    pieces = F.split("formatted", END)
    # Every turn ends with the end mark, so the last piece is empty.
    whole = F.slice("_pieces", 1, F.size("_pieces") - 1)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, MIDDLE)
        role = F.substring(piece, len(OPEN) + 1, at - 1 - len(OPEN))
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, at + len(MIDDLE), F.length(piece))).alias("text"))

    cuts = F.transform(whole, lambda piece, i: F.struct(piece.alias("piece"), F.get("mask", i).alias("mask")))
    under = F.transform(
        F.filter("_cuts", lambda c: c["mask"]["loss"]),
        lambda c: unescape(F.substring(c["piece"], c["mask"]["before"] + 1, c["mask"]["chars"])),
    )
    read = formatted.withColumn("_pieces", pieces).withColumn("_cuts", cuts)
    return read.withColumns({"turns": F.transform(whole, turn), "loss_texts": under}).drop("_pieces", "_cuts")
