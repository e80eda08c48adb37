"""All registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Arrays are joined to text here so that results compare across engines; the
operators themselves return arrays and maps.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import enums, lists
from ..functions.maps import map_invert
from ..operators import catalog, chunks, closure, grants, inventory, joins, maptables, policies, summaries, usage
from ..sources import exports, ledger, load, readers, sinks
from ..sources.session import scratch_path
from ..streaming import jobs
from ..streaming import usage as usage_stream
from .fixtures import fixture, part_maps, table, tagged_fields, word_lists

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2025, 1, 1, tzinfo=timezone.utc)

ORDER_TAGS = {
    "o_orderkey": "order_key", "o_custkey": "customer_key", "o_orderstatus": "status",
    "o_totalprice": "total_price", "o_orderdate": "order_date", "o_orderpriority": "priority",
}
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
BATCH_ROWS = 1000
EXPORT_RANGE = 1 << 16
TOP_TABLES = 3
SESSION_GAP, SESSION_DELAY = "30 minutes", "1 hour"
CHUNK_ROWS = 500
PAYLOAD_ROWS = 200
PAYLOAD_BYTES = 5000
LINE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
SIGN_PARTS = ("au", "en", "th")


def _text(column: Column | str, separator: str = ",") -> Column:
    return F.array_join(column, separator)


def _on(name: str, job: Callable[..., DataFrame], **options) -> Query:
    """Query that runs a job over one fixture."""
    return lambda spark, sf: job(fixture(spark, sf, name), **options)


def _policies(spark: SparkSession, sf: str) -> DataFrame:
    """The policies over all cores: parsing one costs much more than reading the key that it is made from."""
    return fixture(spark, sf, "policies", spread=True)


def _on_policies(job: Callable[..., DataFrame], arrays: tuple[str, ...] = ()) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = job(_policies(spark, sf), AS_OF)
        return rows.withColumns({a: _text(a) for a in arrays}) if arrays else rows

    return run


# --- inventory ---------------------------------------------------------------

def _inventory(job: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: job(fixture(spark, sf, "listing"), fixture(spark, sf, "locations"))


def _large(job: Callable[..., DataFrame], **options) -> Query:
    """The route for catalogues of any size, over one that grows with the parts and suppliers."""
    return lambda spark, sf: job(fixture(spark, sf, "listing"), fixture(spark, sf, "locations_large"), **options)


def storage_per_table(spark: SparkSession, sf: str) -> DataFrame:
    return inventory.storage_per_table(_inventory(inventory.inventory_full)(spark, sf))


# --- sources and sinks -------------------------------------------------------

def _scan_hive(spark: SparkSession, sf: str) -> DataFrame:
    for name in ("customer", "nation"):
        table(spark, sf, name).createOrReplaceTempView(name)
    return readers.scan_hive(
        spark,
        "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    )


def _scan_bind_args(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "orders").createOrReplaceTempView("orders")
    return readers.scan_bound(
        spark,
        "SELECT o_orderpriority, count_if(o_totalprice > ?) AS above, count_if(o_orderstatus = ?) AS in_status "
        "FROM orders GROUP BY o_orderpriority",
        250000, "F",
    )


def _scan_as_text(spark: SparkSession, sf: str) -> DataFrame:
    return readers.as_text(table(spark, sf, "orders"))


def _scan_typed(spark: SparkSession, sf: str) -> DataFrame:
    return readers.as_typed(readers.as_text(table(spark, sf, "orders")), ORDERS_SCHEMA)


def _exec_statement(spark: SparkSession, sf: str) -> DataFrame:
    readers.exec_statement(
        spark,
        "CREATE OR REPLACE TEMPORARY VIEW order_status AS SELECT o_orderstatus, count(*) AS orders "
        f"FROM parquet.`{sf.rstrip('/')}/orders.parquet` GROUP BY o_orderstatus",
    )
    return spark.table("order_status")


def _batch_process(spark: SparkSession, sf: str) -> DataFrame:
    def summary(batch: pd.DataFrame) -> pd.DataFrame:
        grouped = batch.groupby("l_returnflag", as_index=False)["l_quantity"].agg(["size", "sum"])
        return pd.DataFrame({
            "l_returnflag": grouped["l_returnflag"], "row_count": grouped["size"],
            "quantity": grouped["sum"].astype("int64"), "batch_rows": len(batch),
        })

    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity")
    parts = chunks.batch_process(
        lines, BATCH_ROWS, [summary], "l_returnflag string, row_count bigint, quantity bigint, batch_rows bigint"
    )
    return parts.groupBy("l_returnflag").agg(
        F.sum("row_count").alias("row_count"), F.sum("quantity").alias("quantity"),
        F.count_if(F.col("batch_rows") > BATCH_ROWS).alias("oversized"),
    )


def _exported(rows: DataFrame, field: str | None = None) -> str:
    """Path of an export with the rows' ``body`` documents."""
    path = scratch_path(rows.sparkSession, "export")
    exports.write_export(rows, path, field)
    return path


def _scan_policies(spark: SparkSession, sf: str) -> DataFrame:
    bodies = exports.read_policies(spark, _exported(_policies(spark, sf)), range_bytes=EXPORT_RANGE)
    read = policies.scan_policies(bodies, ["HIVE", "cos", "unknown"])
    return read.select("id", F.col("doc.name").alias("name"), F.col("doc.serviceType").alias("service_type"))


def _policies_by_id(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "orders").select(F.col("o_custkey").cast("int").alias("id"))
    return policies.policies_by_id(fixture(spark, sf, "policies"), ids)


def _service_types(spark: SparkSession, sf: str) -> DataFrame:
    body = F.to_json(F.struct(
        "id", "name", F.lit(True).alias("isEnabled"), F.struct(F.lit("true").alias("enableDenyAndExceptionsInPolicies")).alias("options"),
        F.array(F.struct(F.lit(1).alias("itemId"), F.col("name").alias("name"))).alias("accessTypes"),
    ))
    path = _exported(fixture(spark, sf, "definitions").select(body.alias("body")), "serviceDefs")
    return policies.service_types(exports.read_definitions(spark, path, range_bytes=EXPORT_RANGE))


def _policies_missing(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("int").alias("id"))
    return policies.missing_policies(fixture(spark, sf, "policies"), ids)


def _user_lookup(spark: SparkSession, sf: str) -> DataFrame:
    users = fixture(spark, sf, "users")
    body = F.to_json(F.struct("id", "name", F.array("id").alias("groupIdList"), F.lit('a \\ "{[').alias("description")))
    ordered = users.repartitionByRange("seq").sortWithinPartitions("seq")
    path = _exported(ordered.select(body.alias("body")), "vXUsers")
    read = exports.read_users(spark, path, range_bytes=EXPORT_RANGE)
    return policies.user_lookup(fixture(spark, sf, "lookups"), read.select("name", "id", "seq"), "seq")


def _scan_inventory(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "listing")
    fixture(spark, sf, "listing").write.parquet(path)
    return readers.scan_inventory(spark, path)


def _load_payloads(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    columns = ["c_name", "c_mktsegment", "c_custkey", "c_nationkey"]
    return load.load_payloads(rows, "sales", "customer", columns, ["c_custkey"], PAYLOAD_ROWS, "b1")


def _load_once(spark: SparkSession, sf: str) -> DataFrame:
    """One load twice over, and a second batch; the rows as the ledger has them."""
    columns = ["c_name", "c_mktsegment", "c_custkey", "c_nationkey"]
    rows = table(spark, sf, "customer")
    path = scratch_path(spark, "loads")
    for batch, part in (("b1", F.col("c_custkey") % 3 > 0), ("b1", F.col("c_custkey") % 3 > 0), ("b2", F.col("c_custkey") % 3 == 0)):
        ledger.load_once(load.load_payloads(rows.where(part), "sales", "customer", columns, ["c_custkey"], PAYLOAD_ROWS, batch, PAYLOAD_BYTES), path)
    schema = "array<struct<c_name: string, c_mktsegment: string, c_custkey: bigint, c_nationkey: int>>"
    bodies = ledger.loaded_bodies(spark, path)
    return bodies.select(F.octet_length("body").alias("bytes"), F.explode(F.from_json("body", schema)).alias("row")).select(
        "row.*", (F.col("bytes") <= PAYLOAD_BYTES).alias("bounded")
    )


def _gated(spark: SparkSession, sf: str) -> load.Load:
    schema = "c_custkey bigint, c_acctbal int, c_mktsegment string"
    return load.strict_load(fixture(spark, sf, "raw_load"), schema, where="c_mktsegment <> 'FURNITURE'")


def _strict_load(spark: SparkSession, sf: str) -> DataFrame:
    return _gated(spark, sf).result


def _load_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Both outcomes of the gate, row by row."""
    gated = _gated(spark, sf)
    good, bad = readers.as_text(gated.good).withColumn("outcome", F.lit("good")), gated.rejects.withColumn("outcome", F.lit("reject"))
    return good.unionByName(bad).select("c_custkey", "c_mktsegment", "outcome")


def _report_sink(spark: SparkSession, sf: str) -> DataFrame:
    sheets = [
        table(spark, sf, "customer").select("c_custkey", "c_name"),
        table(spark, sf, "supplier").select("s_suppkey", "s_name"),
    ]
    paths = sinks.report_sink(scratch_path(spark, "report"), sheets, titles=["id", "name"])
    pages = [
        spark.read.option("header", True).schema("id string, name string").csv(p).withColumn("sheet", F.lit(p.rsplit("/", 1)[1]))
        for p in paths
    ]
    return pages[0].unionByName(pages[1])


def _text_sink(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select(
        F.concat_ws("|", "doc_id", F.replace("text", F.lit("\n"), F.lit("\\n"))).alias("value")
    )
    path = sinks.text_sink(lines, scratch_path(spark, "text"))
    return spark.read.option("lineSep", "\n").text(path)


# --- grants ------------------------------------------------------------------

def _grant_flat(spark: SparkSession, sf: str) -> DataFrame:
    flat = grants.grant_flat(fixture(spark, sf, "grants"))
    return flat.withColumn("permissions", _text("permissions"))


def _enum_lookup(spark: SparkSession, sf: str) -> DataFrame:
    name, index = F.col("name"), F.col("c_nationkey") - 2
    return fixture(spark, sf, "names").select(
        "c_custkey",
        enums.name_index(name, enums.PRIVILEGES).alias("privilege_code"),
        enums.name_index(name, enums.GRANT_OBJECT_TYPES).alias("object_code"),
        enums.name_index(name, enums.ACTIONS).alias("action_code"),
        enums.name_at(index, enums.PRIVILEGES).alias("privilege_name"),
        enums.name_at(index, enums.ACTIONS).alias("action_name"),
        enums.name_at(index, enums.SERVICE_TYPES, "unknown service type").alias("service_name"),
    )


# --- lists and maps ----------------------------------------------------------

def _on_words(**columns: Callable[[], Column]) -> Query:
    return lambda spark, sf: word_lists(spark, sf).select(
        "doc_id", *[make().alias(n) for n, make in columns.items()]
    )


def _last_word() -> Column:
    return F.try_element_at(F.col("a"), F.lit(-1))


def _chunk_rows(spark: SparkSession, sf: str) -> DataFrame:
    numbered = chunks.chunk_rows(table(spark, sf, "lineitem").select(*LINE_KEYS), CHUNK_ROWS, *LINE_KEYS)
    return numbered.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "position", "chunk_id")


def _map_text(m: str | Column) -> Column:
    pairs = F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return _text(F.array_sort(pairs))


def _map_invert(spark: SparkSession, sf: str) -> DataFrame:
    return part_maps(spark, sf).select("p_partkey", _map_text(map_invert(F.col("m"))).alias("inverted"))


def _map_widest(spark: SparkSession, sf: str) -> DataFrame:
    return maptables.map_widest(part_maps(spark, sf), "m", "p_partkey").select(_map_text("m").alias("widest"))


# --- catalogues --------------------------------------------------------------

def _schema_names(spark: SparkSession, sf: str) -> DataFrame:
    fields = tagged_fields(spark, sf)
    typed = catalog.schema_names(fields, "orm", True, "column:").select(
        F.lit("type").alias("kind"), F.col("column_name").alias("name"), F.col("type").alias("value")
    )
    named = catalog.schema_names(fields, "json", False).select(
        F.lit("column").alias("kind"), F.col("field_name").alias("name"), F.col("column_name").alias("value")
    )
    return typed.unionByName(named)


def _schema_rename(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    for column, name in ORDER_TAGS.items():
        orders = orders.withMetadata(column, {"orm": f"column:{column},size:8", "json": name})
    mapping = catalog.tag_mapping(orders, "orm", "json", from_key="column:")
    return catalog.schema_rename(orders, mapping)


def _log_step(action: str) -> Query:
    return _on("querylog", usage.log_names, action=action)


def _pol_filters(spark: SparkSession, sf: str) -> DataFrame:
    steps = [lambda d: d.where("status"), lambda d: d.where("grantee_type = 'USER'")]
    flat = policies.policy_flat(_policies(spark, sf), AS_OF, steps)
    return flat.select("policy_id", "permission_type", "object_type", "object_name", "grantee")


# --- usage and grants over time ----------------------------------------------

def _asof_grants(spark: SparkSession, sf: str) -> DataFrame:
    used, versions = fixture(spark, sf, "usage_events"), fixture(spark, sf, "grant_versions")
    joined = joins.asof_join(
        used, versions, ["user_id"], "run_at", "valid_from", ["grant_id", "catalog", "valid_from", "user_identity", "grant_sql"], ["grant_id"]
    )
    parsed = grants.parse_grants(joined)
    granted = F.col("grant_id").isNotNull()
    return parsed.select(
        "query_id", "user_id", "run_at", "grant_id", "valid_from",
        *[F.when(granted, c).alias(n) for n, c in (
            ("permissions", _text("permissions")), ("object_db_name", F.col("object_db_name")), ("object_tbl_name", F.col("object_tbl_name")),
        )],
    )


def _usage_in_validity(spark: SparkSession, sf: str) -> DataFrame:
    used, schedules = fixture(spark, sf, "usage_events").select("query_id", "team", "run_at", "done_at"), fixture(spark, sf, "schedules")
    pairs = joins.overlap_join(used, schedules, ("run_at", "done_at"), ("valid_from", "valid_until"), ["team"])
    return pairs.select("query_id", "schedule_id", "team", "run_at", "valid_from", "valid_until")


def _usage_topk(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.usage_top(usage.log_usage(fixture(spark, sf, "querylog")), TOP_TABLES)


def _inv_diff(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.snapshot_difference(fixture(spark, sf, "listing"), fixture(spark, sf, "listing_after"), "name")


def _timed_usage(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """The usage events with an instant, and the path where they stand as files for a stream."""
    used = fixture(spark, sf, "usage_events").withColumn("run_at", F.col("run_at").cast("timestamp"))
    path = scratch_path(spark, "events")
    used.write.parquet(path)
    return used, path


def _usage_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions from the stream; a last event far off lets the watermark pass all others, in a second run from the checkpoint."""
    used, path = _timed_usage(spark, sf)
    out, checkpoint = scratch_path(spark, "sessions"), scratch_path(spark, "checkpoint")

    def run() -> None:
        stream = jobs.stream_files(spark, path, used.schema)
        jobs.run_job(stream, lambda s: usage_stream.usage_sessions(s, "user_id", "run_at", SESSION_GAP, SESSION_DELAY), out, checkpoint).awaitTermination()

    run()
    last = used.agg(F.max("run_at").alias("run_at")).where("run_at is not null")
    end = last.select(*[
        (F.col("run_at") + F.expr("INTERVAL 400 DAYS")).alias("run_at") if c == "run_at" else F.lit(None).cast(used.schema[c].dataType).alias(c)
        for c in used.columns
    ])
    end.write.mode("append").parquet(path)
    run()
    read = spark.read.schema("user bigint, started timestamp, ended timestamp, events bigint").parquet(out)
    return read.select("user", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("started", "ended")], "events")


def _usage_last_use(spark: SparkSession, sf: str) -> DataFrame:
    """First and last use of each table, kept in a stream's state over two runs from one checkpoint."""
    used, path = _timed_usage(spark, sf)
    out, checkpoint = scratch_path(spark, "uses"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        stream = jobs.stream_files(spark, path, used.schema, files_per_trigger=4)
        usage_stream.run_last_use(spark, stream, out, checkpoint, "table_name", "run_at", "400 days", 400 * 86_400_000).awaitTermination()
    latest = usage_stream.latest_use(spark, out)
    times = [F.timestamp_micros(f"{c}_us").cast("timestamp_ntz").alias(f"{c}_use") for c in ("first", "last")]
    return latest.select(F.col("key").alias("table_name"), *times, "uses")


QUERIES: dict[str, Query] = {
    "storage_per_table": storage_per_table,
    # sources and sinks
    "scan_hive": _scan_hive,
    "scan_bind_args": _scan_bind_args,
    "scan_as_text": _scan_as_text,
    "scan_typed": _scan_typed,
    "exec_statement": _exec_statement,
    "batch_process": _batch_process,
    "scan_policies": _scan_policies,
    "policies_by_id": _policies_by_id,
    "policies_missing": _policies_missing,
    "service_types": _service_types,
    "user_lookup": _user_lookup,
    "scan_inventory": _scan_inventory,
    "load_payloads": _load_payloads,
    "load_once": _load_once,
    "strict_load": _strict_load,
    "load_rows": _load_rows,
    "report_sink": _report_sink,
    "text_sink": _text_sink,
    # storage inventory
    "inv_levels": _on("listing", inventory.inventory_levels),
    "inv_convention_table": _on("listing", inventory.convention_table),
    "inv_type_code": _on("listing", inventory.type_codes),
    "inv_rejects": _on("listing", inventory.inventory_rejects),
    "inv_location_match": _inventory(inventory.match_locations),
    "inv_location_prefix": _inventory(inventory.match_location_prefixes),
    "inv_location_match_large": _large(inventory.match_locations, plan_patterns=16),
    "inv_location_prefix_large": _large(inventory.match_location_prefixes, broadcast_locations=16),
    "inv_slim": _on("listing", inventory.inventory_slim),
    "inv_full": _inventory(inventory.inventory_full),
    "inv_rollup": _on("listing", summaries.path_rollup),
    "inv_diff": _inv_diff,
    # grants
    "grant_grantee": _on("grants", grants.grant_grantees),
    "grant_object_type": _on("grants", grants.grant_object_types),
    "grant_object_name": _on("grants", grants.grant_object_names),
    "grant_privileges": _on("grants", grants.grant_privileges),
    "grant_flat": _grant_flat,
    "enum_lookup": _enum_lookup,
    "grant_rejects": _on("grants_mixed", lambda g: grants.grant_rejects(g).select("grant_id", "grant_sql", "reject_reason")),
    "grant_effective": _on("role_grants", closure.effective_grants),
    "asof_grants": _asof_grants,
    # query log
    "log_default_catalog": _on("querylog", usage.log_default_catalog),
    "log_clean": _on("querylog", usage.log_clean),
    "log_session": _on("querylog", usage.log_session),
    "log_from": _log_step("FROM"),
    "log_join": _log_step("JOIN"),
    "log_cte": _log_step("WITH"),
    "log_extract_arg": _log_step("EXTRACT TIME"),
    "log_insert": _log_step("INSERT"),
    "log_create": _log_step("CREATE"),
    "log_drop": _log_step("DROP"),
    "log_alter": _log_step("ALTER"),
    "log_update": _log_step("UPDATE"),
    "log_delete": _log_step("DELETE"),
    "log_truncate": _log_step("TRUNCATE"),
    "log_select": _on("querylog", usage.log_select),
    "log_ignore_lists": _on("querylog", usage.log_ignored, ignore_tables=["T3"], ignore_signs=["old_"]),
    "log_qualify": _on("querylog", usage.log_qualified),
    "log_usage": _on("querylog", usage.log_usage),
    "log_errors": _on("querylog", usage.log_errors),
    "usage_topk": _usage_topk,
    "usage_in_validity": _usage_in_validity,
    "usage_sessions": _usage_sessions,
    "usage_last_use": _usage_last_use,
    # access policies
    "pol_object_type": lambda spark, sf: policies.policy_object_types(_policies(spark, sf)),
    "pol_objects": _on_policies(policies.policy_objects, ("object_column",)),
    "pol_validity_text": lambda spark, sf: policies.policy_validity(_policies(spark, sf)),
    "pol_expired": _on_policies(policies.policy_expired),
    "pol_items": _on_policies(policies.policy_item_rows, ("object_restriction",)),
    "pol_privileges": _on_policies(policies.policy_privileges, ("permission",)),
    "pol_grantees": _on_policies(policies.policy_grantees),
    "pol_status": _on_policies(policies.policy_status_rows),
    "pol_flat": _on_policies(
        policies.policy_flat, ("permission", "object_column", "object_restriction", "validity_schedules")
    ),
    "pol_filters": _pol_filters,
    "pol_rejects": _on_policies(lambda b, as_of: policies.policy_rejects(b, as_of).select("id", "reject_reason")),
    # lists, maps, schemas
    "list_intersect": _on_words(words=lambda: _text(lists.list_intersect(F.col("a"), F.col("b")), "|")),
    "list_contains": _on_words(found=lambda: lists.list_contains(F.col("b"), F.lower(_last_word()))),
    "list_index": _on_words(
        first=lambda: lists.list_index(F.col("a"), _last_word()),
        missing=lambda: lists.list_index(F.col("a"), F.lit("no such word")),
    ),
    "list_minus": _on_words(words=lambda: _text(lists.list_minus(F.col("a"), F.col("b")), "|")),
    "list_match_any": _on_words(found=lambda: lists.list_match_any(F.col("text"), SIGN_PARTS)),
    "list_drop_matching": _on_words(words=lambda: _text(lists.list_drop_matching(F.col("a"), SIGN_PARTS), "|")),
    "list_distinct": _on_words(words=lambda: _text(lists.list_distinct(F.col("a")), "|")),
    "list_distinct_lower": _on_words(words=lambda: _text(lists.list_distinct_lower(F.col("a")), "|")),
    "chunk_rows": _chunk_rows,
    "map_invert": _map_invert,
    "map_widest": _map_widest,
    "map_to_table": lambda spark, sf: maptables.map_to_table(part_maps(spark, sf), "m", "p_partkey"),
    "map_max_lengths": lambda spark, sf: maptables.map_max_lengths(part_maps(spark, sf), "m"),
    "ddl_create": _on("catalogue", catalog.ddl_statements, kind="create"),
    "ddl_select": _on("catalogue", catalog.ddl_statements, kind="select", db="lake"),
    "schema_names": _schema_names,
    "schema_rename": _schema_rename,
}
