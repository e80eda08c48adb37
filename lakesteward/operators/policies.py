"""Access-policy documents -> one row per policy, object, grantee and item kind.

The document is parsed once. Objects, items and grantees then come from chained
explodes, which stream row by row: the cross product of a policy's resources is
never held as one array, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.enums import POLICY_OBJECT_TYPES, SERVICE_TYPES, names_array
from ..functions.rows import settle, unnest, unnest_placed
from ..functions.text import bind, or_empty, trim_ws
from ..sources.schemas import POLICY

FLAT_COLUMNS = [
    "policy_id", "policy_name", "permission_type", "permission", "object_type", "object_name",
    "object_db_name", "object_tbl_name", "object_column", "object_restriction", "grantee_type",
    "grantee", "is_enable", "is_override", "validity_schedules", "status",
]

# What "*" stands for in each kind of resource.
ALL_NAMES = {
    "hiveservice": "ALL HIVE SERVICE",
    "global": "ALL GLOBAL UDF",
    "url": "ALL URL",
    "database": "ALL DATABASE",
    "table": "ALL TABLE",
    "path": "ALL PATH",
    "queue": "ALL QUEUE",
    "mountpoint": "ALL MOUNT POINT",
    "bucket": "ALL BUCKET",
}

# Object type -> the resource kinds it is built from.
_MADE_OF = {
    "HIVE SERVICE": ("hiveservice",),
    "GLOBAL UDF": ("global",),
    "URL": ("url",),
    "DATABASE": ("database",),
    "HDFS": ("path",),
    "YARN": ("queue",),
    "CHDFS": ("mountpoint", "path"),
    "COS": ("bucket", "path"),
    "TABLE": ("database", "table"),
    "COLUMN": ("database", "table"),
}
# These take the first database and table as they are, "*" included.
_FIRST_ONLY = ("MASKING", "ROW FILTER")
_IN_DATABASE = ("DATABASE", "TABLE", "COLUMN", *_FIRST_ONLY)
_IN_TABLE = ("TABLE", "COLUMN", *_FIRST_ONLY)
_TWO_NAMES = ("CHDFS", "COS")


def _texts() -> Column:
    return F.array().cast("array<string>")


def _values(kind: str) -> Column:
    return F.coalesce(F.col(f"doc.resources.`{kind}`.values"), _texts())


def _count(field: str) -> Column:
    """Length of a list in the document; a missing list counts as empty."""
    return F.coalesce(F.size(F.col(f"doc.{field}")), F.lit(0))


# --- reading -----------------------------------------------------------------

def parse_policies(bodies: DataFrame) -> DataFrame:
    """JSON text in ``body`` -> typed document in ``doc`` (NULL id and type when unreadable)."""
    return bodies.withColumn("doc", F.from_json("body", POLICY, {"mode": "PERMISSIVE"}))


def scan_policies(bodies: DataFrame, service_types: Sequence[str] = ()) -> DataFrame:
    """Documents of the given service types, or of all known ones. Unknown types are ignored."""
    wanted = [s.lower() for s in service_types or SERVICE_TYPES]
    wanted = [s for s in wanted if s in SERVICE_TYPES]
    return settle(parse_policies(bodies), ["doc"]).where(F.lower("doc.serviceType").isin(wanted))


def policies_by_id(policies: DataFrame, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Policies with the given ids: a list, or a table with an ``id`` column. ``missing_policies`` tells which ids have none."""
    if isinstance(ids, DataFrame):
        return policies.join(ids.select("id").distinct(), "id", "left_semi")
    if not ids:
        raise ValueError("id list can not be empty")
    return policies.where(F.col("id").isin(list(ids)))


def missing_policies(policies: DataFrame, ids: DataFrame) -> DataFrame:
    """The ids of a table with an ``id`` column that no policy has, each once. Null ids are left out."""
    asked = ids.select("id").where("id is not null").distinct()
    return asked.join(policies.select("id"), "id", "left_anti")


# --- objects -----------------------------------------------------------------

def object_type() -> Column:
    """Kind of object a policy protects; NULL when it is none of the known kinds."""
    hive = (
        F.when(_count("dataMaskPolicyItems") > 0, "MASKING")
        .when(_count("rowFilterPolicyItems") > 0, "ROW FILTER")
        .when(F.size(_values("hiveservice")) > 0, "HIVE SERVICE")
        .when(F.size(_values("url")) > 0, "URL")
        .when(F.size(_values("udf")) > 0, F.when(F.size(_values("database")) > 1, "UDF").otherwise("GLOBAL UDF"))
        .when(F.size(_values("column")) > 0, "COLUMN")
        .when(F.size(_values("table")) > 0, "TABLE")
        .otherwise("DATABASE")
    )
    other = F.upper("doc.serviceType")
    return F.when(F.col("doc.serviceType") == "hive", hive).when(other.isin(*POLICY_OBJECT_TYPES), other)


def _names_at(place: int) -> Column:
    """First or second name list of the object type, with "*" spelled out.

    Types with one list get a single blank second name.
    """
    kind = F.col("object_type")
    chosen = F.when(kind.isin(*_FIRST_ONLY), F.slice(_values(("database", "table")[place]), 1, 1))
    star = F.when(kind.isin(*_FIRST_ONLY), "*")
    for made, kinds in _MADE_OF.items():
        if place < len(kinds):
            chosen = chosen.when(kind == made, _values(kinds[place]))
            star = star.when(kind == made, ALL_NAMES[kinds[place]])
    if place:
        chosen = chosen.otherwise(F.array(F.lit("")))
    return F.transform(chosen, lambda v: F.when(v == "*", star).otherwise(or_empty(v)))


def with_objects(typed: DataFrame) -> DataFrame:
    """One row per protected object: two explodes give the cross product of two name lists."""
    kind = F.col("object_type")
    rows = unnest(unnest(typed, F.col("_ones"), "_one"), F.col("_twos"), "_two")
    both = F.concat_ws(" AND ", "_one", "_two")
    return rows.withColumns({
        "object_name": F.when(kind.isin(*_IN_DATABASE), "").when(kind.isin(*_TWO_NAMES), both).otherwise(F.col("_one")),
        "object_db_name": F.when(kind.isin(*_IN_DATABASE), trim_ws(F.col("_one"))).otherwise(""),
        "object_tbl_name": F.when(kind.isin(*_IN_TABLE), trim_ws(F.col("_two"))).otherwise(""),
    })


# --- validity ----------------------------------------------------------------

def _clock(text: Column) -> Column:
    """``yyyy/M/d H:m:s`` padded to two digits; NULL when it is no such time."""
    pieces = F.regexp_extract_all(text, F.lit(r"([0-9]++)"), F.lit(1))
    shaped = text.rlike(r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}\z")
    two = F.transform(pieces, lambda p: F.when(F.length(p) < 2, F.lpad(p, 2, "0")).otherwise(p))
    return F.when(
        shaped,
        F.concat(
            F.array_join(F.slice(two, 1, 3), "-"), F.lit(" "), F.array_join(F.slice(two, 4, 3), ":")
        ),
    )


def _schedules() -> Column:
    return F.coalesce(F.col("doc.validitySchedules"), F.array().cast(
        "array<struct<startTime:string,endTime:string,timeZone:string>>"
    ))


def _zone(schedule: Column) -> Column:
    return or_empty(schedule["timeZone"])


def _instant(clock: Column, zone: Column) -> Column:
    """Instant of a clock time in a zone; NULL for a bad time or an unknown zone. No zone is UTC."""
    zone = F.when(zone == "", "UTC").otherwise(zone)
    return F.concat(clock, F.lit(" "), zone).try_cast("timestamp")


def schedule_times() -> Column:
    """Padded start and end, and the zone, of every schedule."""
    return F.transform(
        _schedules(),
        lambda s: F.struct(
            _clock(s["startTime"]).alias("start"), _clock(s["endTime"]).alias("end"), _zone(s).alias("zone")
        ),
    )


def _as_text(times: Column) -> Column:
    return F.transform(times, lambda t: F.concat(t["start"], F.lit("~"), t["end"], F.lit("~"), t["zone"]))


def validity_text() -> Column:
    """``start~end~zone`` of every schedule; NULL elements where a time is bad."""
    return bind(schedule_times(), _as_text)


def is_expired(as_of: datetime | Column) -> Column:
    """Only the end of the last schedule counts; a policy without schedules never expires."""
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    last = F.try_element_at(F.col("_ends"), F.lit(-1))
    return F.coalesce(moment.cast("timestamp") > last, F.lit(False))


# --- items and grantees ------------------------------------------------------

# Item kind, list in the document, and where its restriction comes from. The order is fixed.
_ITEM_LISTS = (
    ("", "rowFilterPolicyItems", lambda i: i["rowFilterInfo"]["filterExpr"]),
    ("", "dataMaskPolicyItems", lambda i: i["dataMaskInfo"]["dataMaskType"]),
    ("PolicyItem", "policyItems", None),
    ("DenyPolicyItem", "denyPolicyItems", None),
    ("AllowException", "allowExceptions", None),
    ("DenyException", "denyExceptions", None),
)

_ITEM_TYPE = (
    "array<struct<permission_type:string,restriction:array<string>,permission:array<string>,"
    "users:array<string>,groups:array<string>,roles:array<string>>>"
)


def policy_items() -> Column:
    """All six item lists of a policy as one array of alike structs."""
    def tagged(kind, field, restriction):
        def item(i):
            limits = F.array(or_empty(restriction(i))) if restriction else _texts()
            granted = F.transform(i["accesses"], lambda a: or_empty(a["type"]))
            return F.struct(
                F.lit(kind).alias("permission_type"),
                limits.alias("restriction"),
                F.coalesce(granted, _texts()).alias("permission"),
                *[F.coalesce(i[n], _texts()).alias(n) for n in ("users", "groups", "roles")],
            )

        return F.coalesce(F.transform(F.col(f"doc.{field}"), item), F.array().cast(_ITEM_TYPE))

    return F.concat(*[tagged(*entry) for entry in _ITEM_LISTS])


def item_grantees(item: Column) -> Column:
    """Users, groups and roles of an item; a list of exactly one blank name names nobody."""
    def named(names: Column) -> Column:
        nobody = (F.size(names) == 1) & (F.get(names, F.lit(0)) == "")
        return F.when(nobody, _texts()).otherwise(names)

    def of(kind: str, field: str) -> Column:
        names = bind(F.transform(item[field], lambda n: trim_ws(or_empty(n))), named)
        return F.transform(names, lambda n: F.struct(F.lit(kind).alias("grantee_type"), n.alias("grantee")))

    return F.concat(of("USER", "users"), of("GROUP", "groups"), of("ROLE", "roles"))


def policy_status() -> Column:
    """False if disabled, expired, or an exception without the items it is an exception from."""
    kind = F.col("permission_type")
    orphan_allow = (kind == "AllowException") & ~F.col("_has_items")
    orphan_deny = (kind == "DenyException") & ~F.col("_has_denials")
    return ~(~F.col("is_enable") | F.col("_expired") | orphan_allow | orphan_deny)


# --- the job -----------------------------------------------------------------

def _typed(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Input columns, and all a policy contributes to its rows, in short lists.

    The document itself is left behind here, so that the explodes copy little.
    ``reject_reason`` tells why a policy cannot be flattened, NULL if it can.
    """
    docs = parse_policies(bodies) if "doc" not in bodies.columns else bodies
    typed = docs.withColumns({"object_type": object_type(), "_times": schedule_times()})
    kind = F.col("object_type")
    first_only = kind.isin(*_FIRST_ONLY)
    unnamed = (F.size(_values("database")) == 0) | (F.size(_values("table")) == 0)
    instants = F.transform("_times", lambda t: _instant(t["end"], t["zone"]))
    slim = typed.select(
        *[f"`{c}`" for c in bodies.columns if c != "doc"],
        "object_type",
        F.coalesce("doc.id", F.lit(0)).alias("policy_id"),
        or_empty(F.col("doc.name")).alias("policy_name"),
        F.coalesce("doc.isEnabled", F.lit(False)).alias("is_enable"),
        (F.coalesce("doc.policyPriority", F.lit(0)) != 0).alias("is_override"),
        (_count("policyItems") > 0).alias("_has_items"),
        (_count("denyPolicyItems") > 0).alias("_has_denials"),
        _names_at(0).alias("_ones"),
        _names_at(1).alias("_twos"),
        F.when(kind.isin("COLUMN", "MASKING"), F.transform(_values("column"), or_empty)).otherwise(_texts()).alias("object_column"),
        policy_items().alias("_items"),
        _as_text(F.col("_times")).alias("validity_schedules"),
        instants.alias("_ends"),
        F.when(F.col("doc").isNull() | (F.col("doc.id").isNull() & F.col("doc.serviceType").isNull()), "unreadable document")
        .when(kind.isNull() | (kind == "UDF"), "unsupported object")
        .when(first_only & unnamed, "no database or table")
        .alias("_reason"),
    )
    bad_schedule = F.exists("validity_schedules", lambda v: v.isNull()) | F.exists("_ends", lambda e: e.isNull())
    judged = slim.withColumns({
        "_expired": is_expired(as_of),
        "reject_reason": F.coalesce("_reason", F.when(bad_schedule, "bad schedule")),
    })
    return settle(judged, [c for c in judged.columns if c not in bodies.columns])


def _good(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return _typed(bodies, as_of).where("reject_reason is null")


def policy_rejects(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return _typed(bodies, as_of).where("reject_reason is not null").select(
        *[f"`{c}`" for c in bodies.columns if c != "doc"], "reject_reason"
    )


def policy_object_types(bodies: DataFrame) -> DataFrame:
    """Policy and object type, '' when unknown."""
    return parse_policies(bodies).select("id", or_empty(object_type()).alias("object_type"))


def policy_objects(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return with_objects(_good(bodies, as_of)).select(
        "policy_id", "object_type", "object_name", "object_db_name", "object_tbl_name", "object_column"
    )


def policy_validity(bodies: DataFrame) -> DataFrame:
    return unnest_placed(parse_policies(bodies), validity_text(), "place", "validity", "id")


def policy_expired(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return _good(bodies, as_of).select("policy_id", F.col("_expired").alias("is_expired"))


def _with_items(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    rows = unnest(_good(bodies, as_of), F.col("_items"), "_item")
    return rows.withColumns({
        "permission_type": F.col("_item.permission_type"),
        "permission": F.col("_item.permission"),
        "object_restriction": F.col("_item.restriction"),
    })


def policy_item_rows(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return _with_items(bodies, as_of).select("policy_id", "permission_type", "object_restriction")


def policy_privileges(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return _with_items(bodies, as_of).select("policy_id", "permission_type", "permission")


def policy_grantees(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    rows = unnest(_with_items(bodies, as_of), item_grantees(F.col("_item")), "_grantee")
    return rows.select("policy_id", "permission_type", "_grantee.grantee_type", "_grantee.grantee")


def policy_status_rows(bodies: DataFrame, as_of: datetime | Column) -> DataFrame:
    return _with_items(bodies, as_of).select(
        "policy_id", "permission_type", "is_enable", "is_override", policy_status().alias("status")
    )


def policy_flat(
    bodies: DataFrame, as_of: datetime | Column, filters: Sequence[Callable[[DataFrame], DataFrame]] = ()
) -> DataFrame:
    """The flat grant table; ``filters`` are applied to it one after another.

    Filters on whole policies are cheaper before this call, since they cannot
    be pushed below the explodes.
    """
    rows = _with_items(bodies, as_of).withColumn("status", policy_status())
    rows = unnest(rows, item_grantees(F.col("_item")), "_grantee")
    rows = rows.withColumns({
        "grantee_type": F.col("_grantee.grantee_type"), "grantee": F.col("_grantee.grantee"),
    })
    flat = with_objects(rows).select(*FLAT_COLUMNS)
    for step in filters:
        flat = flat.transform(step)
    return flat


def service_types(definitions: DataFrame) -> DataFrame:
    """Known service types among the definitions, with their position in the catalogue."""
    name = F.lower("name")
    index = F.array_position(names_array(SERVICE_TYPES), name) - 1
    known = definitions.select(name.alias("service_type"), F.coalesce(index, F.lit(-1)).cast("int").alias("service_type_id"))
    return known.where("service_type_id >= 0")


def user_lookup(names: DataFrame, users: DataFrame, order: str) -> DataFrame:
    """Adds the ``id`` of each ``name``: 0 when unknown, the last by ``order`` when listed twice.

    The aggregate combines before its shuffle and leaves one row per name. The
    join is left to the engine, which broadcasts the side only when it is small
    and splits hot names otherwise.
    """
    latest = users.groupBy("name").agg(F.max_by("id", order).alias("id"))
    return names.join(latest, "name", "left").withColumn("id", F.coalesce("id", F.lit(0)))
