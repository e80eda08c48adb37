"""The same queries as plain SQL over the given tables, for a second engine.

Each is worked out on its own in relational terms (unnest, group, window), so
agreement means more than the same expression evaluated twice.
"""

from __future__ import annotations

from ..functions.enums import (
    ACTIONS, GRANT_OBJECT_TYPES, POLICY_OBJECT_TYPES, PRIVILEGES, SERVICE_TYPES,
)
from . import fixtures

_LEVELS = [f"extend_level{k}_name" for k in range(7)]


def _list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def _fixture(name: str) -> str:
    statement = fixtures.STATEMENTS[name]
    for word in ("user", "group"):
        statement = statement.replace(f"`{word}`", f'"{word}"')
    statement = statement.replace("TIMESTAMP_NTZ", "TIMESTAMP")
    return f"{name} AS ({statement})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- inventory ---------------------------------------------------------------

_SPLIT = "split AS (SELECT *, string_split(name, '/') AS p, len(string_split(name, '/')) AS n FROM listing)"
_GOOD = "good AS (SELECT * FROM split WHERE n >= 2 AND type IN ('FILE', 'DIR'))"


def _level(k: int) -> str:
    shown = "type = 'DIR'" if k == 6 else f"(type = 'DIR' OR n - 2 >= {k})"
    return f"CASE WHEN {shown} THEN coalesce(p[{k + 1}], '') ELSE '' END AS {_LEVELS[k]}"


_PATH = (
    "CAST(CASE WHEN n = 2 AND p[2] = '' THEN 0 ELSE n - 1 END AS INT) AS path_level, "
    f"'/' AS {_LEVELS[0]}, " + ", ".join(_level(k) for k in range(1, 7))
)
_OWNED = r"n > 5 AND regexp_matches(p[5], '(?i)\.db')"
_CONV_DB = r"lower(regexp_replace(p[5], '(?i)\.db', '', 'g'))"


def _convention(column: str) -> str:
    value = {
        "table_name": f"{_CONV_DB} || '.' || lower(p[6])", "db_name": _CONV_DB, "tbl_name": "lower(p[6])",
    }[column]
    return f"CASE WHEN {_OWNED} THEN {value} ELSE '' END"


_OWNERS = ("table_name", "db_name", "tbl_name")
_CONVENTION = ", ".join(f"{_convention(c)} AS {c}" for c in _OWNERS)
_TYPE = "CAST(CASE type WHEN 'FILE' THEN 2 ELSE 1 END AS INT) AS type, size_byte AS size"


def _located(condition: str, rank: str) -> str:
    return (
        "paths AS (SELECT DISTINCT name AS path FROM good), "
        f"hits AS (SELECT path, table_name AS target, row_number() OVER (PARTITION BY path ORDER BY {rank}, pattern) AS rn "
        f"FROM paths JOIN (SELECT DISTINCT * FROM locations) l ON {condition}), "
        "owned AS (SELECT g.*, h.target FROM good g LEFT JOIN hits h ON h.path = g.name AND h.rn = 1)"
    )


_BY_PATTERN = _located("regexp_matches(path, l.pattern, 'i')", "length(pattern) DESC")
_BY_PREFIX = _located(
    "lower(path) = lower(l.pattern) OR starts_with(lower(path), lower(l.pattern) || '/')", "length(pattern) DESC"
)
_OWNER = (
    f"coalesce(target, {_convention('table_name')}) AS table_name, "
    f"CASE WHEN target IS NOT NULL THEN split_part(target, '.', 1) ELSE {_convention('db_name')} END AS db_name, "
    f"CASE WHEN target IS NOT NULL THEN split_part(target, '.', 2) ELSE {_convention('tbl_name')} END AS tbl_name, "
    "target IS NOT NULL AS is_table"
)


def _inventory(select: str, *extra: str) -> str:
    base = [_fixture("listing"), _SPLIT, _GOOD]
    if extra:
        base = [_fixture("locations"), *base, *extra]
    return _with(*base) + select


_FULL = (
    f'SELECT name, {_PATH}, {_OWNER}, {_TYPE}, atime, mtime, ctime, acl, "user", "group", '
    "try_cast(dt AS DATE) AS dt FROM owned"
)

INVENTORY = {
    "storage_per_table": _inventory(
        f"SELECT db_name, tbl_name, CAST(sum(size) AS BIGINT) AS total_size, count(*) AS objects FROM ({_FULL}) "
        "GROUP BY db_name, tbl_name", _BY_PATTERN,
    ),
    "inv_levels": _inventory(f"SELECT name, type, {_PATH} FROM good"),
    "inv_convention_table": _inventory(f"SELECT name, {_CONVENTION} FROM good"),
    "inv_type_code": _inventory(f"SELECT name, {_TYPE} FROM good"),
    "inv_rejects": _inventory(
        "SELECT name, type, size_byte, dt, CASE WHEN n < 2 THEN 'path' ELSE 'type' END AS reject_reason "
        "FROM split WHERE n < 2 OR type NOT IN ('FILE', 'DIR')"
    ),
    "inv_location_match": _inventory(f"SELECT name, {_OWNER} FROM owned", _BY_PATTERN),
    "inv_location_prefix": _inventory(f"SELECT name, {_OWNER} FROM owned", _BY_PREFIX),
    "inv_slim": _inventory(f"SELECT name, {_PATH}, {_CONVENTION}, {_TYPE} FROM good"),
    "inv_full": _inventory(_FULL, _BY_PATTERN),
}


# --- grants ------------------------------------------------------------------

def _plural(name: str) -> str:
    return name[:-1] + "IES" if name.endswith("POLICY") else name + "S"


def _words(name: str) -> str:
    return name.replace(" ", r"\s+")


# One row per statement and fitting type; the lowest position wins.
_TYPE_ROWS = " UNION ALL ".join(
    f"SELECT {i} AS pos, '{t}' AS kind, '{_plural(t)}' AS plural, "
    rf"'(?i)^\s+ON\s+{_words(t)}' AS one, '(?i)^\s+ON\s+ALL\s+{_words(_plural(t))}' AS every"
    for i, t in enumerate(GRANT_OBJECT_TYPES)
)
_GRANT_PARTS = (
    _fixture("grants"),
    r"""bodies AS (SELECT *, regexp_replace(regexp_replace(grant_sql, '(?i)^grant', ''), '(?is)\s+to\s+.*$', '') AS body,
    string_split(trim(replace(user_identity, '''', '')), '@') AS who FROM grants)""",
    r"""parts AS (SELECT *, regexp_extract(body, '(?is)\s+on\s.*$') AS tail,
    regexp_replace(body, '(?is)\s+on\s.*$', '') AS head FROM bodies)""",
    f"kinds AS ({_TYPE_ROWS})",
    """fits AS (SELECT grant_id, arg_min(struct_pack(kind := kind, plural := plural, one := one, every := every), pos) AS k
    FROM parts, kinds WHERE regexp_matches(tail, one) OR regexp_matches(tail, every) GROUP BY grant_id)""",
    """typed AS (SELECT p.*, CASE WHEN tail = '' THEN 'ROLE' ELSE coalesce(k.kind, '') END AS object_type, k.plural AS plural,
    coalesce(regexp_matches(tail, k.every), false) AS is_all,
    regexp_replace(regexp_replace(tail, k.every, ''), k.one, '') AS rest FROM parts p LEFT JOIN fits USING (grant_id))""",
    r"""scoped AS (SELECT *, trim(replace(rest, '''', '')) AS plain,
    CASE WHEN is_all THEN rest ELSE regexp_extract(rest, '(?is)\s+in\s.*$') END AS scope FROM typed)""",
    r"""named AS (SELECT *,
    object_type IN ('TABLE', 'VIEW', 'MATERIALIZED VIEW', 'FUNCTION') AS dotted,
    object_type IN ('MASKING POLICY', 'ROW ACCESS POLICY') AS policy,
    CASE WHEN regexp_matches(scope, '(?i)all\s+databases') THEN 'ALL DATABASES'
      ELSE trim(regexp_replace(scope, '(?i)(in\s+database|'')', '', 'g')) END AS scope_db FROM scoped)""",
    r"""flat AS (SELECT *,
    CASE WHEN dotted OR object_type IN ('', 'ROLE', 'SYSTEM', 'DATABASE') THEN ''
      WHEN is_all THEN 'ALL ' || plural
      WHEN policy THEN trim(replace(regexp_replace(rest, '(?is)\s+in\s.*$', ''), '''', ''))
      ELSE plain END AS object_name,
    CASE WHEN (dotted AND is_all) OR policy THEN scope_db
      WHEN dotted THEN split_part(plain, '.', 1)
      WHEN object_type = 'DATABASE' AND is_all THEN 'ALL DATABASES'
      WHEN object_type = 'DATABASE' THEN plain ELSE '' END AS object_db_name,
    CASE WHEN dotted AND is_all THEN 'ALL ' || plural WHEN dotted THEN split_part(plain, '.', 2) ELSE '' END AS object_tbl_name,
    CASE len(who) WHEN 1 THEN 'ROLE' WHEN 2 THEN 'USER' ELSE '' END AS grantee_type,
    CASE WHEN len(who) <= 2 THEN who[1] ELSE '' END AS grantee_name,
    CASE WHEN len(who) = 2 THEN who[2] ELSE '' END AS ip,
    NOT coalesce((dotted AND NOT is_all AND NOT contains(rest, '.')) OR (policy AND NOT is_all AND scope = ''), false) AS good
    FROM named)""",
    r"""tokens AS (SELECT grant_id, object_type, t.i, trim(replace(t.v, '''', '')) AS raw,
    regexp_replace(upper(regexp_replace(trim(t.v), '\s+', ' ', 'g')), ' ?PRIVILEGES$', '') AS token
    FROM flat, unnest(string_split(head, ',')) WITH ORDINALITY t(v, i))""",
    f"""privileges AS (
    SELECT grant_id, CAST(i - 1 AS INT) AS place, raw AS permission FROM tokens WHERE object_type = 'ROLE'
    UNION ALL
    SELECT grant_id, CAST(row_number() OVER (PARTITION BY grant_id ORDER BY pos) - 1 AS INT), token FROM (
      SELECT DISTINCT grant_id, token, list_position({_list(PRIVILEGES)}, token) AS pos FROM tokens
      WHERE object_type <> 'ROLE' AND list_contains({_list(PRIVILEGES)}, token)))""",
)


def _grants(select: str) -> str:
    return _with(*_GRANT_PARTS) + select


def _code(names) -> str:
    return f"CAST(coalesce(list_position({_list(names)}, upper(name)), 0) - 1 AS INT)"


def _name_at(names, unknown: str) -> str:
    i = "c_nationkey - 2"
    return f"CASE WHEN {i} BETWEEN 0 AND {len(names) - 1} THEN {_list(names)}[{i} + 1] ELSE '{unknown}' END"


GRANTS = {
    "grant_grantee": _grants("SELECT grant_id, grantee_type, grantee_name, ip FROM flat"),
    "grant_object_type": _grants("SELECT grant_id, object_type FROM flat"),
    "grant_object_name": _grants(
        "SELECT grant_id, object_name, object_db_name, object_tbl_name FROM flat WHERE good"
    ),
    "grant_privileges": _grants("SELECT grant_id, place, permission FROM privileges"),
    "grant_flat": _grants(
        "SELECT f.grant_id, catalog, coalesce(permissions, '') AS permissions, object_type, object_name, object_db_name, "
        "object_tbl_name, grantee_type, grantee_name, ip, grant_sql FROM flat f LEFT JOIN "
        "(SELECT grant_id, string_agg(permission, ',' ORDER BY place) AS permissions FROM privileges GROUP BY grant_id) g "
        "USING (grant_id) WHERE good"
    ),
    "enum_lookup": _with(_fixture("names")) + (
        f"SELECT c_custkey, {_code(PRIVILEGES)} AS privilege_code, {_code(GRANT_OBJECT_TYPES)} AS object_code, "
        f"{_code(ACTIONS)} AS action_code, {_name_at(PRIVILEGES, 'nil')} AS privilege_name, "
        f"{_name_at(ACTIONS, 'nil')} AS action_name, {_name_at(SERVICE_TYPES, 'unknown service type')} AS service_name "
        "FROM names"
    ),
}


# --- query log ---------------------------------------------------------------

_ID = r"[\p{L}0-9_]+"
_BQ = r"`[^`]+`"
_MORE = rf"(?:\s*\.\s*(?:{_ID}|{_BQ}))"
_FIRST = rf"(?:\s+{_ID}|\s*{_BQ})"
_NAME = rf"({_FIRST}{_MORE}*)"
_KIND = r"(?:table|view|materialized\s+view)"
_EDGE = r"(?:^|\s)"
_ELEMENT = rf"\s*(?:{_ID}|{_BQ}){_MORE}*(?:\s+as\b)?(?:\s+{_ID}|\s*{_BQ})?"
_SCANS = {
    "FROM": rf"{_EDGE}from{_NAME}",
    "JOIN": rf"{_EDGE}join{_NAME}",
    "WITH": rf"(?:with|,)(\s*(?:{_ID}|{_BQ}))(?:\s*\([^)]+\))?\s+as\s*\(",
    "EXTRACT TIME": rf"extract\s*\([^)]+from{_NAME}",
    "INSERT": rf"insert\s+(?:into|overwrite){_NAME}",
    "CREATE": rf"create\s+{_KIND}(?:\s+if\s+not\s+exists)?{_NAME}",
    "DROP": rf"drop\s+(?:temporary\s+)?{_KIND}(?:\s+if\s+exists)?{_NAME}",
    "ALTER": rf"{_EDGE}alter\s+{_KIND}{_NAME}",
    "UPDATE": rf"{_EDGE}update{_NAME}",
    "DELETE": rf"{_EDGE}delete\s+from{_NAME}",
    "TRUNCATE": rf"{_EDGE}truncate\s+table{_NAME}",
}


def _scan(action: str) -> str:
    found = f"regexp_extract_all(q, '(?i){_SCANS[action]}', 1)"
    if action != "JOIN":
        return found
    lists = rf"regexp_extract_all(q, '(?i){_EDGE}from{_FIRST}{_MORE}*(?:\s+as\b)?(?:\s+{_ID}|\s*{_BQ})?((?:\s*,{_ELEMENT})+)', 1)"
    listed = rf"flatten(list_transform({lists}, lambda t: regexp_extract_all(t, ',(\s*(?:{_ID}|{_BQ}){_MORE}*)', 1)))"
    return f"list_concat({listed}, {found})"


def _parts(name: str) -> str:
    return rf"list_transform(regexp_extract_all(lower({name}), '({_BQ}|{_ID})', 1), lambda p: replace(p, '`', ''))"


def _canonical(name: str) -> str:
    return f"'`' || array_to_string({_parts(name)}, '`.`') || '`'"


_LITERALS = ["'(?:\\\\.|[^\\\\'])*'".replace("'", "''"), '"(?:\\\\.|[^\\\\"])*"']


def _without(text: str, patterns) -> str:
    for pattern in patterns:
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return text


_LINES = r"string_split(regexp_replace(query, '(?s)\\n|/\*.*?\*/', chr(10), 'g'), chr(10))"
_LOG = (
    _fixture("querylog"),
    f"""cleaned AS (SELECT query_id, catalog, db_name, {_without(
        f"array_to_string(list_filter(list_transform({_LINES}, lambda x: {_without('x', [*_LITERALS, '--.*$'])}), lambda x: trim(x) <> ''), chr(10))",
        _LITERALS)} AS q FROM querylog)""",
    rf"""steps AS (SELECT query_id, s.i, {_parts(rf"regexp_extract(s.v, '(?i){_EDGE}set\s+catalog({_FIRST})', 1)")} AS c,
    {_parts(rf"regexp_extract(s.v, '(?i){_EDGE}use({_FIRST}{_MORE}?)', 1)")} AS u
    FROM cleaned, unnest(string_split(q, ';')) WITH ORDINALITY s(v, i) WHERE contains(q, ';'))""",
    """changes AS (SELECT query_id, i * 2 AS seq, c[1] AS cat, NULL AS db FROM steps WHERE len(c) > 0
    UNION ALL SELECT query_id, i * 2 + 1, CASE WHEN len(u) = 2 THEN u[1] END, u[-1] FROM steps WHERE len(u) > 0)""",
    """latest AS (SELECT query_id, arg_max(cat, seq) FILTER (cat IS NOT NULL) AS cat, arg_max(db, seq) FILTER (db IS NOT NULL) AS db
    FROM changes GROUP BY query_id)""",
    """session AS (SELECT query_id,
    coalesce(cat, CASE WHEN replace(catalog, ' ', '') = '' THEN 'default_catalog' ELSE replace(catalog, '`', '') END) AS session_catalog,
    coalesce(db, replace(db_name, '`', '')) AS session_db FROM cleaned LEFT JOIN latest USING (query_id))""",
    "scans AS (" + " UNION ALL ".join(
        f"SELECT query_id, '{a}' AS action, {_scan(a)} AS found FROM cleaned" for a in _SCANS
    ) + ")",
    f"""hits AS (SELECT query_id, action, {_canonical('h.v')} AS name, min(h.i) AS ord
    FROM scans, unnest(found) WITH ORDINALITY h(v, i) GROUP BY ALL)""",
    """kept AS (SELECT * FROM hits WHERE NOT (action = 'DROP' AND contains(name, '#tableau_')))""",
    """placed AS (SELECT query_id, action, name,
    CAST(row_number() OVER (PARTITION BY query_id, action ORDER BY ord) - 1 AS INT) AS place FROM kept)""",
    """barred AS (SELECT query_id, name FROM hits WHERE action IN ('EXTRACT TIME', 'WITH', 'DELETE'))""",
    """read AS (SELECT query_id, name, min(CASE action WHEN 'FROM' THEN 0 ELSE 1000000 END + ord) AS ord
    FROM hits WHERE action IN ('FROM', 'JOIN') GROUP BY ALL)""",
    """selected AS (SELECT query_id, name, CAST(row_number() OVER (PARTITION BY query_id ORDER BY ord) - 1 AS INT) AS place
    FROM read r WHERE NOT EXISTS (SELECT 1 FROM barred b WHERE b.query_id = r.query_id AND b.name = r.name)
    AND name NOT IN ('`dual`', '`unnest`', '`files`', '`generate_series`'))""",
    """refs AS (SELECT query_id, action, name, place FROM placed WHERE action NOT IN ('FROM', 'JOIN', 'WITH', 'EXTRACT TIME')
    UNION ALL SELECT query_id, 'SELECT', name, place FROM selected)""",
    f"""split_refs AS (SELECT r.*, {_parts('name')} AS p, session_catalog, session_db FROM refs r JOIN session USING (query_id))""",
    """qualified AS (SELECT query_id, action, name, place,
    len(p) > 3 OR (len(p) = 1 AND session_db = '') AS is_error,
    CASE len(p) WHEN 3 THEN p[1] ELSE session_catalog END AS catalog,
    CASE len(p) WHEN 1 THEN session_db WHEN 2 THEN p[1] ELSE p[2] END AS db_name,
    p[-1] AS table_name FROM split_refs)""",
)


def _log(select: str) -> str:
    return _with(*_LOG) + select


def _log_names(action: str) -> str:
    return _log(f"SELECT query_id, place, name FROM placed WHERE action = '{action}'")


LOG = {
    "log_default_catalog": _with(_fixture("querylog"))
    + "SELECT query_id, CASE WHEN replace(catalog, ' ', '') = '' THEN 'default_catalog' ELSE catalog END AS catalog FROM querylog",
    "log_clean": _log("SELECT query_id, q AS clean_query FROM cleaned"),
    "log_session": _log("SELECT query_id, session_catalog, session_db FROM session"),
    "log_from": _log_names("FROM"),
    "log_join": _log_names("JOIN"),
    "log_cte": _log_names("WITH"),
    "log_extract_arg": _log_names("EXTRACT TIME"),
    "log_insert": _log_names("INSERT"),
    "log_create": _log_names("CREATE"),
    "log_drop": _log_names("DROP"),
    "log_alter": _log_names("ALTER"),
    "log_update": _log_names("UPDATE"),
    "log_delete": _log_names("DELETE"),
    "log_truncate": _log_names("TRUNCATE"),
    "log_select": _log("SELECT query_id, place, name FROM selected"),
    "log_ignore_lists": _log(
        "SELECT query_id, 'table' AS list, name FROM read "
        "WHERE name IN ('`dual`', '`unnest`', '`files`', '`generate_series`', '`t3`') "
        "UNION ALL SELECT query_id, 'sign', name FROM hits WHERE action = 'DROP' AND regexp_matches(name, '#tableau_|old_')"
    ),
    "log_qualify": _log(
        "SELECT query_id, action, name, is_error, CASE WHEN is_error THEN '' ELSE catalog END AS catalog, "
        "CASE WHEN is_error THEN '' ELSE db_name END AS db_name, "
        "CASE WHEN is_error THEN '' ELSE table_name END AS table_name FROM qualified"
    ),
    "log_usage": _log(
        "SELECT query_id, action, catalog, db_name, table_name, "
        "CAST(row_number() OVER (PARTITION BY query_id, action ORDER BY place) - 1 AS INT) AS index "
        "FROM qualified WHERE NOT is_error"
    ),
}


# --- access policies ---------------------------------------------------------

_VALUES = '{"values":["VARCHAR"]}'
_KINDS = ("database", "table", "column", "global", "hiveservice", "udf", "url", "bucket", "mountpoint", "path", "queue", "keyname")
_BASE_ITEM = '"users":["VARCHAR"],"groups":["VARCHAR"],"roles":["VARCHAR"],"accesses":[{"type":"VARCHAR"}]'
_SHAPE = (
    '{"id":"INTEGER","name":"VARCHAR","isEnabled":"BOOLEAN","policyPriority":"INTEGER","serviceType":"VARCHAR",'
    '"resources":{' + ",".join(f'"{k}":{_VALUES}' for k in _KINDS) + "},"
    + ",".join(f'"{f}":[{{{_BASE_ITEM}}}]' for f in ("policyItems", "denyPolicyItems", "allowExceptions", "denyExceptions"))
    + f',"dataMaskPolicyItems":[{{"dataMaskInfo":{{"dataMaskType":"VARCHAR"}},{_BASE_ITEM}}}]'
    + f',"rowFilterPolicyItems":[{{"rowFilterInfo":{{"filterExpr":"VARCHAR"}},{_BASE_ITEM}}}]'
    + ',"validitySchedules":[{"startTime":"VARCHAR","endTime":"VARCHAR","timeZone":"VARCHAR"}]}'
)


def _count(expression: str) -> str:
    return f"coalesce(len({expression}), 0)"


def _values(kind: str) -> str:
    return f'd.resources."{kind}"."values"'


def _objects(made: str, first: str, all_first: str, second: str | None = None, all_second: str = "") -> str:
    """Objects of one type as rows: every first name with every second name."""
    one = f"CASE WHEN a.v = '*' THEN '{all_first}' ELSE a.v END"
    two = f"CASE WHEN b.v = '*' THEN '{all_second}' ELSE b.v END" if second else "''"
    tail = f", unnest({_values(second)}) b(v)" if second else ""
    return (
        f"SELECT id, object_type, {one} AS one, {two} AS two FROM good, unnest({_values(first)}) a(v){tail} "
        f"WHERE object_type = '{made}'"
    )


def _clock(field: str) -> str:
    return f"strftime(strptime(s.v.{field}, '%Y/%m/%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')"


def _items(field: str, kind: str, restriction: str) -> str:
    return (
        f"SELECT id, '{kind}' AS permission_type, {restriction} AS restriction, "
        "coalesce(array_to_string(list_transform(x.v.accesses, lambda a: a.type), ','), '') AS permission, "
        "x.v.users AS users, x.v.groups AS groups, x.v.roles AS roles, "
        f"row_number() OVER () AS item FROM good, unnest(d.{field}) x(v)"
    )


def _named(kind: str, field: str) -> str:
    return (
        f"SELECT i.*, '{kind}' AS grantee_type, trim(g.v) AS grantee FROM items i, unnest({field}) g(v) "
        f"WHERE len({field}) > 1 OR trim({field}[1]) <> ''"
    )


_POLICY = (
    _fixture("policies"),
    f"docs AS (SELECT id, from_json(body, '{_SHAPE}') AS d FROM policies)",
    f"""typed AS (SELECT id, d, CASE WHEN d.serviceType = 'hive' THEN CASE
      WHEN {_count('d.dataMaskPolicyItems')} > 0 THEN 'MASKING'
      WHEN {_count('d.rowFilterPolicyItems')} > 0 THEN 'ROW FILTER'
      WHEN {_count(_values('hiveservice'))} > 0 THEN 'HIVE SERVICE'
      WHEN {_count(_values('url'))} > 0 THEN 'URL'
      WHEN {_count(_values('udf'))} > 0 AND {_count(_values('database'))} > 1 THEN 'UDF'
      WHEN {_count(_values('udf'))} > 0 THEN 'GLOBAL UDF'
      WHEN {_count(_values('column'))} > 0 THEN 'COLUMN'
      WHEN {_count(_values('table'))} > 0 THEN 'TABLE' ELSE 'DATABASE' END
    WHEN list_contains({_list(POLICY_OBJECT_TYPES)}, upper(d.serviceType)) THEN upper(d.serviceType) ELSE '' END AS object_type
    FROM docs)""",
    """ends AS (SELECT id, s.i, s.v.timeZone AS zone, strptime(s.v.endTime, '%Y/%m/%d %H:%M:%S')
      - CASE s.v.timeZone WHEN 'Asia/Shanghai' THEN INTERVAL 8 HOUR ELSE INTERVAL 0 HOUR END AS finish
    FROM docs, unnest(d.validitySchedules) WITH ORDINALITY s(v, i))""",
    """expiry AS (SELECT id, arg_max(finish, i) < TIMESTAMP '2025-01-01 00:00:00' AS expired FROM ends GROUP BY id)""",
    f"""validity AS (SELECT id, CAST(s.i - 1 AS INT) AS place,
    {_clock('startTime')} || '~' || {_clock('endTime')} || '~' || s.v.timeZone AS validity
    FROM docs, unnest(d.validitySchedules) WITH ORDINALITY s(v, i))""",
    """good AS (SELECT t.*, coalesce(expired, false) AS expired, coalesce(d.isEnabled, false) AS is_enable,
    coalesce(d.policyPriority, 0) <> 0 AS is_override FROM typed t LEFT JOIN expiry USING (id) WHERE object_type NOT IN ('', 'UDF'))""",
    "named AS (" + " UNION ALL ".join([
        _objects("HIVE SERVICE", "hiveservice", "ALL HIVE SERVICE"),
        _objects("GLOBAL UDF", "global", "ALL GLOBAL UDF"),
        _objects("URL", "url", "ALL URL"),
        _objects("DATABASE", "database", "ALL DATABASE"),
        _objects("HDFS", "path", "ALL PATH"),
        _objects("YARN", "queue", "ALL QUEUE"),
        _objects("CHDFS", "mountpoint", "ALL MOUNT POINT", "path", "ALL PATH"),
        _objects("COS", "bucket", "ALL BUCKET", "path", "ALL PATH"),
        _objects("TABLE", "database", "ALL DATABASE", "table", "ALL TABLE"),
        _objects("COLUMN", "database", "ALL DATABASE", "table", "ALL TABLE"),
        f"SELECT id, object_type, {_values('database')}[1], {_values('table')}[1] FROM good "
        "WHERE object_type IN ('MASKING', 'ROW FILTER')",
    ]) + ")",
    f"""objects AS (SELECT n.id, n.object_type,
    CASE WHEN n.object_type IN ('CHDFS', 'COS') THEN one || ' AND ' || two
      WHEN n.object_type IN ('DATABASE', 'TABLE', 'COLUMN', 'MASKING', 'ROW FILTER') THEN '' ELSE one END AS object_name,
    CASE WHEN n.object_type IN ('DATABASE', 'TABLE', 'COLUMN', 'MASKING', 'ROW FILTER') THEN trim(one) ELSE '' END AS object_db_name,
    CASE WHEN n.object_type IN ('TABLE', 'COLUMN', 'MASKING', 'ROW FILTER') THEN trim(two) ELSE '' END AS object_tbl_name,
    CASE WHEN n.object_type IN ('COLUMN', 'MASKING') THEN coalesce(array_to_string({_values('column')}, ','), '') ELSE '' END AS object_column
    FROM named n JOIN good g USING (id))""",
    "items AS (" + " UNION ALL ".join([
        _items("rowFilterPolicyItems", "", "x.v.rowFilterInfo.filterExpr"),
        _items("dataMaskPolicyItems", "", "x.v.dataMaskInfo.dataMaskType"),
        _items("policyItems", "PolicyItem", "''"),
        _items("denyPolicyItems", "DenyPolicyItem", "''"),
        _items("allowExceptions", "AllowException", "''"),
        _items("denyExceptions", "DenyException", "''"),
    ]) + ")",
    "grantees AS (" + " UNION ALL ".join([
        _named("USER", "users"), _named("GROUP", "groups"), _named("ROLE", "roles"),
    ]) + ")",
    f"""states AS (SELECT id, k.kind, is_enable AND NOT expired
    AND NOT (k.kind = 'AllowException' AND {_count('d.policyItems')} = 0)
    AND NOT (k.kind = 'DenyException' AND {_count('d.denyPolicyItems')} = 0) AS status, is_enable, is_override, d.name AS policy_name
    FROM good, unnest(['', 'PolicyItem', 'DenyPolicyItem', 'AllowException', 'DenyException']) k(kind))""",
    """flat AS (SELECT s.id AS policy_id, s.policy_name, g.permission_type, g.permission, o.object_type, o.object_name,
    o.object_db_name, o.object_tbl_name, o.object_column, g.restriction AS object_restriction, g.grantee_type, g.grantee,
    s.is_enable, s.is_override, coalesce(v.texts, '') AS validity_schedules, s.status
    FROM grantees g JOIN states s ON s.id = g.id AND s.kind = g.permission_type JOIN objects o ON o.id = g.id
    LEFT JOIN (SELECT id, string_agg(validity, ',' ORDER BY place) AS texts FROM validity GROUP BY id) v ON v.id = g.id)""",
)


def _policies(select: str) -> str:
    return _with(*_POLICY) + select


POLICIES = {
    "scan_policies": _policies(
        "SELECT d.id AS id, d.name AS name, d.serviceType AS service_type FROM docs WHERE d.serviceType IN ('hive', 'cos')"
    ),
    "policies_by_id": _with(_fixture("policies"))
    + "SELECT id, body FROM policies WHERE id IN (SELECT o_custkey FROM orders)",
    "service_types": _with(_fixture("definitions")) + (
        f"SELECT lower(name) AS service_type, CAST(list_position({_list(SERVICE_TYPES)}, lower(name)) - 1 AS INT) AS service_type_id "
        f"FROM definitions WHERE list_contains({_list(SERVICE_TYPES)}, lower(name))"
    ),
    "user_lookup": _with(_fixture("users"), _fixture("lookups")) + (
        "SELECT l.o_orderkey, l.name, coalesce(u.id, 0) AS id FROM lookups l LEFT JOIN "
        "(SELECT name, id FROM users QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq DESC) = 1) u USING (name)"
    ),
    "pol_object_type": _policies("SELECT id, object_type FROM typed"),
    "pol_objects": _policies(
        "SELECT id AS policy_id, object_type, object_name, object_db_name, object_tbl_name, object_column FROM objects"
    ),
    "pol_validity_text": _policies("SELECT id, place, validity FROM validity"),
    "pol_expired": _policies("SELECT id AS policy_id, expired AS is_expired FROM good"),
    "pol_items": _policies("SELECT id AS policy_id, permission_type, restriction AS object_restriction FROM items"),
    "pol_privileges": _policies("SELECT id AS policy_id, permission_type, permission FROM items"),
    "pol_grantees": _policies("SELECT id AS policy_id, permission_type, grantee_type, grantee FROM grantees"),
    "pol_status": _policies(
        "SELECT i.id AS policy_id, permission_type, is_enable, is_override, status FROM items i "
        "JOIN states s ON s.id = i.id AND s.kind = i.permission_type"
    ),
    "pol_flat": _policies("SELECT * FROM flat"),
    "pol_filters": _policies(
        "SELECT policy_id, permission_type, object_type, object_name, grantee FROM flat WHERE status AND grantee_type = 'USER'"
    ),
}


# --- sources and sinks -------------------------------------------------------

def _text_columns() -> str:
    names = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return ", ".join(f"coalesce(CAST({n} AS VARCHAR), '') AS {n}" for n in names)


SOURCES = {
    "scan_hive": "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
    "scan_bind_args": (
        "SELECT o_orderpriority, count(*) FILTER (o_totalprice > 250000) AS above, "
        "count(*) FILTER (o_orderstatus = 'F') AS in_status FROM orders GROUP BY o_orderpriority"
    ),
    "scan_as_text": f"SELECT {_text_columns()} FROM orders",
    "scan_typed": "SELECT * FROM orders",
    "exec_statement": "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
    "batch_process": (
        "SELECT l_returnflag, count(*) AS row_count, CAST(sum(l_quantity) AS BIGINT) AS quantity, "
        "CAST(0 AS BIGINT) AS oversized FROM lineitem GROUP BY l_returnflag"
    ),
    "scan_inventory": _with(_fixture("listing")) + "SELECT * FROM listing",
    "load_payloads": (
        "WITH numbered AS (SELECT *, (row_number() OVER (ORDER BY c_custkey) - 1) AS pos FROM customer) "
        "SELECT 'sales_customer_b1_' || CAST(pos // 200 AS VARCHAR) AS label, "
        "'[\"$.c_name\",\"$.c_mktsegment\",\"$.c_custkey\",\"$.c_nationkey\"]' AS jsonpaths, CAST(count(*) AS INT) AS row_count, "
        "'[' || string_agg(CAST(to_json(struct_pack(c_name := c_name, c_mktsegment := nullif(c_mktsegment, 'BUILDING'), "
        "c_custkey := c_custkey, c_nationkey := c_nationkey)) AS VARCHAR), ',' ORDER BY pos) || ']' AS body "
        "FROM numbered GROUP BY pos // 200"
    ),
    "strict_load": _with(_fixture("raw_load")) + (
        "SELECT CASE WHEN count(*) FILTER (c_acctbal = 'bad') = 0 THEN 'Success' ELSE 'Fail' END AS status, "
        "count(*) AS total_rows, count(*) FILTER (c_mktsegment <> 'FURNITURE' AND c_acctbal <> 'bad') AS loaded_rows, "
        "count(*) FILTER (c_mktsegment <> 'FURNITURE' AND c_acctbal = 'bad') AS filtered_rows, "
        "count(*) FILTER (c_mktsegment = 'FURNITURE') AS unselected_rows FROM raw_load"
    ),
    "report_sink": (
        "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '第1页' AS sheet FROM customer "
        "UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, '第2页' FROM supplier"
    ),
    "text_sink": r"SELECT CAST(doc_id AS VARCHAR) || '|' || replace(text, chr(10), '\n') AS value FROM documents",
}


# --- lists, maps, schemas ----------------------------------------------------

_WORDS = (
    "words AS (SELECT doc_id, text, string_split(text, ' ') AS a, string_split(lower(text), ' ') AS b FROM documents)"
)
# Blanks to trim, as code points: those the documents can hold besides the plain space.
_BLANKS = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 32, 133, 160, 8195, 8232, 8233, 12288))
_SIGNS = ("au", "en", "th")


def _words_query(columns: str) -> str:
    return _with(_WORDS) + f"SELECT doc_id, {columns} FROM words"


def _any_sign(value: str) -> str:
    return " OR ".join(f"contains({value}, '{s}')" for s in _SIGNS)


def _distinct_words(expression: str) -> str:
    return _with(
        _WORDS,
        f"each AS (SELECT doc_id, {expression} AS w, min(t.i) AS ord FROM words, unnest(a) WITH ORDINALITY t(v, i) GROUP BY ALL)",
    ) + "SELECT doc_id, string_agg(w, '|' ORDER BY ord) AS words FROM each GROUP BY doc_id"


_PARTS = (
    "entries AS (SELECT p_partkey, 'name' AS k, p_name AS v FROM part "
    "UNION ALL SELECT p_partkey, 'brand', p_brand FROM part WHERE p_size >= 10 "
    "UNION ALL SELECT p_partkey, 'type', p_type FROM part "
    "UNION ALL SELECT p_partkey, 'kind', p_type FROM part WHERE p_size <= 40 "
    "UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part)"
)


def _ddl(kind: str) -> str:
    if kind == "create":
        line = "'    ' || rpad('`' || column_name || '`', wide + 10, ' ') || '    ' || rpad(type, deep + 10, ' ')"
        head, tail = "'create table default_db.' || table_name || ' ('", "')'"
    else:
        line, head, tail = "'`' || column_name || '`'", "'select'", "'from lake.' || table_name"
    return _with(
        _fixture("catalogue"),
        "sized AS (SELECT *, CAST(max(strlen(column_name)) OVER w AS INT) AS wide, CAST(max(strlen(type)) OVER w AS INT) AS deep "
        "FROM catalogue WINDOW w AS (PARTITION BY table_name))",
    ) + (
        f"SELECT table_name, {head} || chr(10) || string_agg({line}, ',' || chr(10) ORDER BY pos) || chr(10) || {tail} AS statement "
        "FROM sized GROUP BY table_name"
    )


_TRIMMED = f"trim(t.v, {_BLANKS})"

LISTS = {
    "list_intersect": _words_query("coalesce(array_to_string(list_sort(list_intersect(a, b)), '|'), '') AS words"),
    "list_contains": _words_query("list_contains(b, lower(a[-1])) AS found"),
    "list_index": _words_query("CAST(list_position(a, a[-1]) - 1 AS INT) AS first, CAST(-1 AS INT) AS missing"),
    "list_minus": _with(
        _WORDS,
        "flat AS (SELECT doc_id, t.v AS w, t.i AS ord FROM words, unnest(a) WITH ORDINALITY t(v, i))",
        "barred AS (SELECT DISTINCT doc_id, t.v AS w FROM words, unnest(b) t(v))",
        "kept AS (SELECT doc_id, string_agg(w, '|' ORDER BY ord) AS words FROM flat ANTI JOIN barred USING (doc_id, w) GROUP BY doc_id)",
    ) + "SELECT doc_id, coalesce(words, '') AS words FROM documents LEFT JOIN kept USING (doc_id)",
    "list_match_any": _words_query(f"{_any_sign('text')} AS found"),
    "list_drop_matching": _words_query(
        f"coalesce(array_to_string(list_filter(a, lambda w: NOT ({_any_sign('w')})), '|'), '') AS words"
    ),
    "list_distinct": _distinct_words(_TRIMMED),
    "list_distinct_lower": _distinct_words(f"lower({_TRIMMED})"),
    "chunk_rows": (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pos AS position, pos // 500 AS chunk_id FROM ("
        "SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos FROM lineitem)"
    ),
    "map_invert": _with(_PARTS, "swapped AS (SELECT p_partkey, v, max(k) AS k FROM entries GROUP BY ALL)") + (
        "SELECT p_partkey, string_agg(v || '=' || k, ',' ORDER BY v || '=' || k) AS inverted FROM swapped GROUP BY p_partkey"
    ),
    "map_widest": _with(_PARTS, "sizes AS (SELECT p_partkey FROM entries GROUP BY p_partkey ORDER BY count(*) DESC, p_partkey LIMIT 1)")
    + "SELECT string_agg(k || '=' || v, ',' ORDER BY k || '=' || v) AS widest FROM entries JOIN sizes USING (p_partkey)",
    "map_to_table": (
        "SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_brand END AS brand, CASE WHEN p_size <= 40 THEN p_type END AS kind, "
        "p_name AS name, CAST(p_size AS VARCHAR) AS size, p_type AS type FROM part"
    ),
    "map_max_lengths": _with(_PARTS)
    + "SELECT CAST(max(strlen(k)) AS INT) AS max_key_length, CAST(max(strlen(v)) AS INT) AS max_value_length FROM entries",
    "ddl_create": _ddl("create"),
    "ddl_select": _ddl("select"),
    "schema_names": (
        "SELECT 'type' AS kind, 'col_' || CAST(p_partkey AS VARCHAR) AS name, p_type AS value FROM part UNION ALL "
        "SELECT 'column', 'Field' || CAST(p_partkey AS VARCHAR), 'j' || CAST(p_partkey AS VARCHAR) FROM part"
    ),
    "schema_rename": (
        "SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS status, o_totalprice AS total_price, "
        "o_orderdate AS order_date, o_orderpriority AS priority FROM orders"
    ),
}

_ROLLUP_LEVELS = " UNION ALL ".join(
    f"SELECT {k} AS path_level, "
    + ("'/'" if not k else "'/' || " + " || '/' || ".join(_LEVELS[1:k + 1]))
    + " AS path, size, owner FROM leveled"
    + (" WHERE " + " AND ".join(f"{c} <> ''" for c in _LEVELS[1:k + 1]) if k else "")
    for k in range(7)
)
_LISTED = 'name, atime, mtime, ctime, size_byte, type, acl, "user", "group", file_type, dt'

# A dot of a plain pattern stands for one sign, as "_" does in LIKE.
_LARGE = [_fixture("locations_large"), "locations AS (SELECT pattern, min(table_name) AS table_name FROM locations_large GROUP BY pattern)"]
_BY_TEXT = _located(
    "contains(lower(path), lower(split_part(l.pattern, '.', 1))) AND (NOT contains(l.pattern, '.') OR "
    "lower(path) LIKE '%' || replace(replace(lower(l.pattern), '_', '!_'), '.', '_') || '%' ESCAPE '!')", "length(pattern) DESC"
)


def _large(located: str) -> str:
    return _with(*_LARGE, _fixture("listing"), _SPLIT, _GOOD, located) + f"SELECT name, {_OWNER} FROM owned"


# Usage, grants and listings over time.
OVER_TIME = {
    "policies_missing": "SELECT DISTINCT CAST(l_partkey AS INT) AS id FROM lineitem WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)",
    "load_rows": _with(_fixture("raw_load")) + (
        "SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'reject' ELSE 'good' END AS outcome "
        "FROM raw_load WHERE c_mktsegment <> 'FURNITURE'"
    ),
    "load_once": "SELECT c_name, c_mktsegment, c_custkey, c_nationkey, true AS bounded FROM customer",
    "inv_location_match_large": _large(_BY_TEXT),
    "inv_location_prefix_large": _large(_BY_PREFIX),
    "inv_rollup": _inventory(
        "SELECT CAST(path_level AS INT) AS path_level, path, count(*) AS objects, CAST(sum(size) AS BIGINT) AS total_size, "
        f"count(DISTINCT owner) AS owners FROM ({_ROLLUP_LEVELS}) GROUP BY ALL",
        f'leveled AS (SELECT {_PATH}, coalesce(size_byte, 0) AS size, "user" AS owner FROM good)',
    ),
    "inv_diff": _with(
        _fixture("listing"), _fixture("listing_after"),
        f"gone AS (SELECT {_LISTED} FROM listing EXCEPT ALL SELECT {_LISTED} FROM listing_after)",
        f"come AS (SELECT {_LISTED} FROM listing_after EXCEPT ALL SELECT {_LISTED} FROM listing)",
        f"moved AS (SELECT {_LISTED}, -count(*) AS copies FROM gone GROUP BY ALL UNION ALL SELECT {_LISTED}, count(*) FROM come GROUP BY ALL)",
    ) + (
        f"SELECT {_LISTED}, CAST(copies AS BIGINT) AS copies, CASE WHEN name IN (SELECT name FROM gone) AND name IN (SELECT name FROM come) THEN 'changed' "
        "WHEN copies > 0 THEN 'added' ELSE 'removed' END AS status FROM moved"
    ),
    "grant_rejects": _with(_fixture("grants_mixed")) + (
        "SELECT grant_id, grant_sql, CASE WHEN grant_sql ILIKE '% policy %' THEN 'policy without a database' ELSE 'object without a dot' END AS reject_reason "
        "FROM grants_mixed WHERE NOT grant_sql LIKE '%.%' AND NOT grant_sql ILIKE '% in %'"
    ),
    "grant_effective": "WITH RECURSIVE " + ",\n".join([
        _fixture("role_grants"),
        """parsed AS (SELECT string_split(user_identity, '@') AS who, regexp_extract(grant_sql, 'GRANT (.*?)( ON | TO )', 1) AS items,
        regexp_extract(grant_sql, ' ON TABLE (.*) TO ', 1) AS object FROM role_grants)""",
        """has AS (SELECT DISTINCT who, trim(replace(t.v, '''', '')) AS role FROM parsed, unnest(string_split(items, ',')) t(v) WHERE object = '')""",
        """rights AS (SELECT DISTINCT who, object, trim(t.v) AS permission FROM parsed, unnest(string_split(items, ',')) t(v) WHERE object <> '')""",
        """reach AS (SELECT who, role FROM has UNION SELECT r.who, h.role FROM reach r JOIN has h ON len(h.who) = 1 AND h.who[1] = r.role)""",
        """granted AS (SELECT who, object, permission FROM rights
        UNION SELECT r.who, g.object, g.permission FROM reach r JOIN rights g ON len(g.who) = 1 AND g.who[1] = r.role)""",
    ]) + (
        "\nSELECT CASE len(who) WHEN 1 THEN 'ROLE' ELSE 'USER' END AS grantee_type, who[1] AS grantee_name, coalesce(who[2], '') AS ip, "
        "'TABLE' AS object_type, '' AS object_name, split_part(object, '.', 1) AS object_db_name, split_part(object, '.', 2) AS object_tbl_name, "
        "permission FROM granted"
    ),
    "asof_grants": _with(
        _fixture("usage_events"), _fixture("grant_versions"),
        "latest AS (SELECT * FROM grant_versions QUALIFY row_number() OVER (PARTITION BY user_id, valid_from ORDER BY grant_id DESC) = 1)",
    ) + (
        "SELECT query_id, u.user_id, run_at, grant_id, valid_from, "
        "replace(regexp_extract(grant_sql, 'GRANT (.*) ON TABLE', 1), ', ', ',') AS permissions, "
        r"regexp_extract(grant_sql, 'ON TABLE (\w+)\.', 1) AS object_db_name, regexp_extract(grant_sql, '\.(\w+) TO ', 1) AS object_tbl_name "
        "FROM usage_events u ASOF LEFT JOIN latest v ON u.user_id = v.user_id AND u.run_at >= v.valid_from"
    ),
    "log_errors": _log("SELECT query_id, action, name FROM qualified WHERE is_error"),
    "usage_topk": (
        "SELECT catalog, action, db_name, table_name, uses, CAST(row_number() OVER w AS INT) AS rank "
        f"FROM (SELECT catalog, action, db_name, table_name, count(*) AS uses FROM ({LOG['log_usage']}) GROUP BY ALL) "
        "WINDOW w AS (PARTITION BY catalog, action ORDER BY uses DESC, db_name, table_name) QUALIFY row_number() OVER w <= 3"
    ),
    "usage_in_validity": _with(_fixture("usage_events"), _fixture("schedules")) + (
        "SELECT query_id, schedule_id, u.team, run_at, valid_from, valid_until FROM usage_events u JOIN schedules s ON u.team = s.team "
        "AND coalesce(valid_from <= done_at, true) AND coalesce(valid_until >= run_at, true) AND coalesce(valid_from <= valid_until, true)"
    ),
    "usage_sessions": _with(
        _fixture("usage_events"),
        "marked AS (SELECT user_id, run_at, coalesce(run_at - lag(run_at) OVER w >= INTERVAL 30 MINUTE, true) AS fresh "
        "FROM usage_events WINDOW w AS (PARTITION BY user_id ORDER BY run_at))",
        "numbered AS (SELECT user_id, run_at, count_if(fresh) OVER (PARTITION BY user_id ORDER BY run_at) AS n FROM marked)",
    ) + 'SELECT user_id AS "user", min(run_at) AS started, max(run_at) AS ended, count(*) AS events FROM numbered GROUP BY user_id, n',
    "usage_last_use": _with(_fixture("usage_events"))
    + "SELECT table_name, min(run_at) AS first_use, max(run_at) AS last_use, count(*) AS uses FROM usage_events GROUP BY table_name",
    "pol_rejects": _with(_fixture("policies")) + "SELECT id, 'unsupported object' AS reject_reason FROM policies WHERE id % 13 = 5",
}

ORACLE: dict[str, str] = {**OVER_TIME, **INVENTORY, **GRANTS, **LOG, **POLICIES, **SOURCES, **LISTS}
