"""SQL grant statements -> object, privileges and grantee. One projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.enums import GRANT_OBJECT_TYPES, PRIVILEGES, names_array
from ..functions.rows import settle, unnest_placed
from ..functions.text import or_empty, trim_ws

# Blank characters of the statement text.
_S = r"[ \t\n\f\r]"

# A run of blanks, entered only at its start: tried from every blank, long runs take quadratic time.
_RUN = rf"(?<!{_S}){_S}++"

_DOTTED_TYPES = ("TABLE", "VIEW", "MATERIALIZED VIEW", "FUNCTION")
_POLICY_TYPES = ("MASKING POLICY", "ROW ACCESS POLICY")

FLAT_COLUMNS = [
    "grant_id", "catalog", "permissions", "object_type", "object_name", "object_db_name",
    "object_tbl_name", "grantee_type", "grantee_name", "ip", "grant_sql",
]


def _plural(name: str) -> str:
    return name[:-1] + "IES" if name in _POLICY_TYPES else name + "S"


def _alternation(names) -> str:
    return "|".join(n.replace(" ", _S + "+") for n in names)


# The first type of the catalogue that fits wins, so the alternatives keep its order.
_ONE = rf"(?is)^{_S}+ON{_S}+({_alternation(GRANT_OBJECT_TYPES)})(.*)\z"
_ALL = rf"(?is)^{_S}+ON{_S}+ALL{_S}+({_alternation(_plural(t) for t in GRANT_OBJECT_TYPES)})(.*)\z"


def _squeezed(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, _S + "+", " "))


def _unquoted(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit(""))


def parse_grants(grants: DataFrame) -> DataFrame:
    """All parsed columns plus ``reject_reason`` (NULL for good rows).

    Works in a few projections: statement parts, object type, names.
    """
    statement = or_empty(F.col("grant_sql"))
    body = F.regexp_replace(F.regexp_replace(statement, "(?i)^GRANT", ""), rf"(?is){_RUN}TO{_S}+.*\z", "")
    identity = F.split(trim_ws(_unquoted(or_empty(F.col("user_identity")))), "@")
    parts = grants.withColumn("_body", body).withColumn("_identity", identity)
    parts = parts.withColumn("_tail", F.regexp_extract("_body", rf"(?is){_RUN}ON{_S}+.*\z", 0)).withColumn(
        "_head", F.regexp_replace("_body", rf"(?is){_RUN}ON{_S}+.*\z", "")
    )
    plurals = names_array([_plural(t) for t in GRANT_OBJECT_TYPES])
    typed = parts.withColumn("_plural", _squeezed(F.regexp_extract("_tail", _ALL, 1))).withColumn(
        "_single", _squeezed(F.regexp_extract("_tail", _ONE, 1))
    )
    typed = typed.withColumn("_all", F.col("_plural") != "").withColumn(
        "object_type",
        F.when(F.col("_tail") == "", "ROLE")
        .when(F.col("_all"), F.get(names_array(GRANT_OBJECT_TYPES), (F.array_position(plurals, F.col("_plural")) - 1).cast("int")))
        .otherwise(F.col("_single")),
    ).withColumn(
        "_rest",
        F.when(F.col("_all"), F.regexp_extract("_tail", _ALL, 2)).otherwise(F.regexp_extract("_tail", _ONE, 2)),
    )
    return typed.withColumns(_object_names()).withColumns(
        {"permissions": _permissions(), **_grantee(), "reject_reason": _reject_reason()}
    )


def _grantee() -> dict[str, Column]:
    identity = F.col("_identity")
    count = F.size(identity)
    return {
        "grantee_type": F.when(count == 1, "ROLE").when(count == 2, "USER").otherwise(""),
        "grantee_name": F.when(count <= 2, F.get(identity, F.lit(0))).otherwise(""),
        "ip": F.when(count == 2, F.get(identity, F.lit(1))).otherwise(""),
    }


def _scope(text: Column) -> Column:
    """Database an ``IN ...`` clause names."""
    named = trim_ws(F.regexp_replace(text, rf"(?i)(?:IN{_S}++DATABASE|')", ""))
    return F.when(text.rlike(rf"(?i)ALL{_S}++DATABASES"), "ALL DATABASES").otherwise(named)


_IN_TAIL = rf"(?is){_RUN}IN{_S}.*\z"


def _object_names() -> dict[str, Column]:
    kind, rest, is_all = F.col("object_type"), F.col("_rest"), F.col("_all")
    plain = trim_ws(_unquoted(rest))
    dotted, policy = kind.isin(*_DOTTED_TYPES), kind.isin(*_POLICY_TYPES)
    unnamed = kind.isin("", "ROLE", "SYSTEM")
    every = F.concat(F.lit("ALL "), F.col("_plural"))
    two = F.split(plain, "\\.")
    in_tail = F.regexp_extract(rest, _IN_TAIL, 0)
    before_in = trim_ws(_unquoted(F.regexp_replace(rest, _IN_TAIL, "")))
    return {
        "object_name": F.when(unnamed | dotted | (kind == "DATABASE"), "")
        .when(is_all, every)
        .when(policy, before_in)
        .otherwise(plain),
        "object_db_name": F.when((dotted | policy) & is_all, _scope(rest))
        .when(dotted, or_empty(F.get(two, F.lit(0))))
        .when(policy, _scope(in_tail))
        .when(kind == "DATABASE", F.when(is_all, every).otherwise(plain))
        .otherwise(""),
        "object_tbl_name": F.when(dotted & is_all, every)
        .when(dotted, or_empty(F.get(two, F.lit(1))))
        .otherwise(""),
    }


def _reject_reason() -> Column:
    kind, one = F.col("object_type"), ~F.col("_all")
    no_dot = kind.isin(*_DOTTED_TYPES) & one & ~F.col("_rest").contains(".")
    no_scope = kind.isin(*_POLICY_TYPES) & one & ~F.col("_rest").rlike(_IN_TAIL)
    return F.when(no_dot, "object without a dot").when(no_scope, "policy without a database")


def _permissions() -> Column:
    """Role names in input order; otherwise known privileges in catalogue order."""
    items = F.split(_unquoted(F.col("_head")), ",")
    roles = F.transform(items, trim_ws)
    tokens = F.transform(
        F.split(F.col("_head"), ","),
        lambda t: F.regexp_replace(trim_ws(_squeezed(t)), r" ?PRIVILEGES\z", ""),
    )
    known = F.array_intersect(names_array(PRIVILEGES), tokens)
    return F.when(F.col("object_type") == "ROLE", roles).otherwise(known)


def _settled(grants: DataFrame) -> DataFrame:
    """Parsed statements; filters on any column of theirs do not parse again."""
    parsed = parse_grants(grants)
    made = [c for c in (*FLAT_COLUMNS, "reject_reason") if c not in grants.columns]
    return settle(parsed.select(*[f"`{c}`" for c in grants.columns], *made), made)


def _good(grants: DataFrame) -> DataFrame:
    return _settled(grants).where("reject_reason is null")


def grant_grantees(grants: DataFrame) -> DataFrame:
    return parse_grants(grants).select("grant_id", "grantee_type", "grantee_name", "ip")


def grant_object_types(grants: DataFrame) -> DataFrame:
    return parse_grants(grants).select("grant_id", "object_type")


def grant_object_names(grants: DataFrame) -> DataFrame:
    return _good(grants).select("grant_id", "object_name", "object_db_name", "object_tbl_name")


def grant_privileges(grants: DataFrame) -> DataFrame:
    """One row per statement and privilege, with its place in the list."""
    return unnest_placed(parse_grants(grants), F.col("permissions"), "place", "permission", "grant_id")


def grant_flat(grants: DataFrame) -> DataFrame:
    """One row per statement; ``permissions`` is an array."""
    return _good(grants).select(*FLAT_COLUMNS)


def grant_rejects(grants: DataFrame) -> DataFrame:
    return _settled(grants).where("reject_reason is not null").select(*grants.columns, "reject_reason")
