"""Input tables of the jobs, derived from the given tables.

Each is one statement over whole tables that both engines run; column
quoting is the only difference. Statement text comes first, maps and lists, which
are built in the engines' own way, last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rows import dealt

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

LISTING = """
SELECT b.name, b.atime, b.atime AS mtime, b.atime AS ctime, b.size_byte, b.type,
       'rwxr-x---' AS acl, b.owner AS `user`, 'lake' AS `group`, 'STANDARD' AS file_type, b.dt
FROM (
  SELECT CASE CAST((l_orderkey * 7 + l_linenumber) % 11 AS INT)
           WHEN 0 THEN '/'
           WHEN 1 THEN 'plainname'
           WHEN 2 THEN '/tmp'
           WHEN 3 THEN '/user/hive'
           WHEN 4 THEN '/user/hive/warehouse'
           WHEN 5 THEN concat('/user/hive/warehouse/Sales', CAST(l_suppkey % 5 AS STRING), '.DB')
           WHEN 6 THEN concat('/user/hive/warehouse/Sales', CAST(l_suppkey % 5 AS STRING), '.DB/Tbl_', CAST(l_partkey % 20 AS STRING))
           WHEN 7 THEN concat('/user/hive/warehouse/Sales', CAST(l_suppkey % 5 AS STRING), '.DB/Tbl_', CAST(l_partkey % 20 AS STRING), '/dt=', CAST(CAST(l_shipdate AS DATE) AS STRING))
           WHEN 8 THEN concat('/user/hive/warehouse/Sales', CAST(l_suppkey % 5 AS STRING), '.DB/Tbl_', CAST(l_partkey % 20 AS STRING), '/dt=', CAST(CAST(l_shipdate AS DATE) AS STRING), '/part-', CAST(l_linenumber AS STRING))
           WHEN 9 THEN concat('/ext/zone', CAST(l_suppkey % 5 AS STRING), '/tbl_', CAST(l_partkey % 20 AS STRING), '/raw/f', CAST(l_linenumber AS STRING))
           ELSE concat('/user/hive/warehouse/Sales', CAST(l_suppkey % 5 AS STRING), '.DB/')
         END AS name,
         CAST(CAST(l_shipdate AS DATE) AS STRING) AS atime,
         CAST(l_quantity AS BIGINT) * 1024 AS size_byte,
         CASE WHEN l_partkey % 13 = 0 THEN 'LINK' WHEN l_partkey % 2 = 0 THEN 'DIR' ELSE 'FILE' END AS type,
         concat('u', CAST(l_suppkey % 7 AS STRING)) AS owner,
         CASE WHEN l_linenumber = 4 THEN 'bad' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS dt
  FROM lineitem
) b
"""

LOCATIONS = """
SELECT concat('/ext/zone', CAST(s_suppkey % 5 AS STRING), '/tbl_', CAST(s_suppkey % 20 AS STRING)) AS pattern,
       concat('Ext', CAST(s_suppkey % 5 AS STRING), '.T', CAST(s_suppkey % 20 AS STRING)) AS table_name
FROM supplier
"""

QUERYLOG = """
SELECT o_orderkey AS query_id,
  CASE WHEN o_custkey % 3 = 0 THEN ' ' ELSE concat('cat', CAST(o_custkey % 3 AS STRING)) END AS catalog,
  CASE WHEN o_custkey % 5 = 0 THEN '' ELSE concat('db', CAST(o_custkey % 5 AS STRING)) END AS db_name,
  CASE CAST(o_orderkey % 14 AS INT)
    WHEN 0 THEN concat('SELECT a FROM T', CAST(o_custkey % 9 AS STRING), ' x JOIN other.`My T` y ON x.k = y.k')
    WHEN 1 THEN concat('select * from c1.d1.t', CAST(o_custkey % 9 AS STRING), ' a, d2.t2 as b , t3')
    WHEN 2 THEN concat('WITH w AS (SELECT * FROM base1), v (c) AS (SELECT 1 FROM w) SELECT * FROM v JOIN d', CAST(o_custkey % 4 AS STRING), '.t ON 1 = 1')
    WHEN 3 THEN concat('SELECT extract(year FROM ts) FROM ev', CAST(o_custkey % 9 AS STRING))
    WHEN 4 THEN concat('INSERT INTO d3.tgt SELECT * FROM src', CAST(o_custkey % 9 AS STRING), ' -- from hidden')
    WHEN 5 THEN concat('insert overwrite `d4`.`t 4` select ', chr(39), 'from fake', chr(39), ' from s4 /* join ghost', chr(10), ' from ghost2 */')
    WHEN 6 THEN concat('DROP TABLE IF EXISTS d5.old_t', CAST(o_custkey % 9 AS STRING))
    WHEN 7 THEN concat('drop view `#tableau_tmp', CAST(o_custkey % 9 AS STRING), '`')
    WHEN 8 THEN concat('CREATE TABLE IF NOT EXISTS d6.new', CAST(o_custkey % 9 AS STRING), ' (a int)')
    WHEN 9 THEN concat('ALTER MATERIALIZED VIEW d7.mv', CAST(o_custkey % 9 AS STRING), ' REFRESH')
    WHEN 10 THEN concat('UPDATE c8.d8.t', CAST(o_custkey % 9 AS STRING), ' SET a = 1')
    WHEN 11 THEN concat('DELETE FROM d9.t', CAST(o_custkey % 9 AS STRING), ' WHERE a = 1')
    WHEN 12 THEN CASE WHEN o_custkey % 2 = 0 THEN concat('TRUNCATE TABLE a.b.c.d', CAST(o_custkey % 9 AS STRING))
                      ELSE concat('truncate table `D 10`.t', CAST(o_custkey % 9 AS STRING)) END
    ELSE concat('SET CATALOG Hive; use dbX; SELECT * FROM dual JOIN t', CAST(o_custkey % 9 AS STRING))
  END AS query
FROM orders
"""

GRANTS = """
SELECT c_custkey AS grant_id, 'default_catalog' AS catalog,
  CASE WHEN c_custkey % 4 = 0 THEN concat('role', CAST(c_custkey % 6 AS STRING))
       ELSE concat(chr(39), 'u', CAST(c_custkey % 50 AS STRING), chr(39), '@', chr(39), '%', chr(39)) END AS user_identity,
  concat(
    CASE CAST(c_custkey % 12 AS INT)
      WHEN 0 THEN 'GRANT SELECT, INSERT ON TABLE db1.t1'
      WHEN 1 THEN 'GRANT DELETE, UPDATE, SELECT ON ALL TABLES IN DATABASE db2'
      WHEN 2 THEN 'grant select on all views in all databases'
      WHEN 3 THEN 'GRANT CREATE TABLE, DROP, CREATE MATERIALIZED VIEW ON DATABASE db3'
      WHEN 4 THEN 'GRANT ALL ON ALL DATABASES'
      WHEN 5 THEN 'GRANT USAGE ON CATALOG hive'
      WHEN 6 THEN 'GRANT OPERATE, NODE, CREATE RESOURCE GROUP ON SYSTEM'
      WHEN 7 THEN concat('GRANT IMPERSONATE ON USER ', chr(39), 'bob', chr(39), '@', chr(39), '%', chr(39))
      WHEN 8 THEN 'GRANT APPLY ON MASKING POLICY mp IN DATABASE db4'
      WHEN 9 THEN 'GRANT ALTER ON ALL ROW ACCESS POLICIES IN ALL DATABASES'
      WHEN 10 THEN concat('GRANT ', chr(39), 'r1', chr(39), ', ', chr(39), 'r2', chr(39))
      ELSE 'GRANT USAGE ON GLOBAL FUNCTION f(int)' END,
    ' TO ', 'someone') AS grant_sql
FROM customer
"""

POLICIES = """
SELECT CAST(c_custkey AS INT) AS id,
  concat('{"id":', CAST(c_custkey AS STRING), ',"name":"p', CAST(c_custkey AS STRING), '","isEnabled":',
    CASE WHEN c_custkey % 10 = 0 THEN 'false' ELSE 'true' END, ',"policyPriority":', CAST(c_custkey % 2 AS STRING),
    CASE CAST(c_custkey % 13 AS INT)
      WHEN 0 THEN ',"serviceType":"hive","resources":{"database":{"values":["*"]}}'
      WHEN 1 THEN ',"serviceType":"hive","resources":{"database":{"values":["d1","*"]},"table":{"values":["t1","*"]}}'
      WHEN 2 THEN ',"serviceType":"hive","resources":{"database":{"values":["d2"]},"table":{"values":["t2"]},"column":{"values":["c1","c2"]}}'
      WHEN 3 THEN ',"serviceType":"cos","resources":{"bucket":{"values":["b1","*"]},"path":{"values":["/p","*"]}}'
      WHEN 4 THEN ',"serviceType":"hdfs","resources":{"path":{"values":["/x","*"]}}'
      WHEN 5 THEN ',"serviceType":"kms","resources":{"keyname":{"values":["k"]}}'
      WHEN 6 THEN ',"serviceType":"hive","resources":{"database":{"values":["d6"]},"table":{"values":["t6"]}},"rowFilterPolicyItems":[{"rowFilterInfo":{"filterExpr":"a > 1"},"users":["u1"],"groups":[],"roles":[],"accesses":[{"type":"select","isAllowed":true}]}]'
      WHEN 7 THEN ',"serviceType":"yarn","resources":{"queue":{"values":["q1","*"]}}'
      WHEN 8 THEN ',"serviceType":"chdfs","resources":{"mountpoint":{"values":["m1","*"]},"path":{"values":["/p"]}}'
      WHEN 9 THEN ',"serviceType":"hive","resources":{"url":{"values":["s3://x","*"]}}'
      WHEN 10 THEN ',"serviceType":"hive","resources":{"hiveservice":{"values":["*"]}}'
      WHEN 11 THEN ',"serviceType":"hive","resources":{"database":{"values":["d"]},"udf":{"values":["f"]},"global":{"values":["g","*"]}}'
      ELSE ',"serviceType":"hive","resources":{"database":{"values":["d7"]},"table":{"values":["t7"]},"column":{"values":["c7"]}},"dataMaskPolicyItems":[{"dataMaskInfo":{"dataMaskType":"MASK"},"users":["u1"],"groups":["g1"],"roles":[],"accesses":[{"type":"select","isAllowed":true}]}]' END,
    CASE WHEN c_custkey % 13 NOT IN (6, 12) AND c_custkey % 3 <> 0 THEN ',"policyItems":[{"users":["a "," b"],"groups":[" "],"roles":["r1"],"accesses":[{"type":"select","isAllowed":true},{"type":"update","isAllowed":true}]}]' ELSE '' END,
    CASE WHEN c_custkey % 4 = 0 THEN ',"denyPolicyItems":[{"users":["y"],"groups":["",""],"roles":[],"accesses":[{"type":"all","isAllowed":true}]}]' ELSE '' END,
    CASE WHEN c_custkey % 5 = 0 THEN ',"allowExceptions":[{"users":["x"],"groups":[],"roles":[],"accesses":[{"type":"drop","isAllowed":true}]}]' ELSE '' END,
    CASE WHEN c_custkey % 6 = 0 THEN ',"denyExceptions":[{"users":[],"groups":["g9"],"roles":[],"accesses":[{"type":"read","isAllowed":false}]}]' ELSE '' END,
    CASE WHEN c_custkey % 7 = 0 THEN ',"validitySchedules":[{"startTime":"2020/1/2 3:4:5","endTime":"2099/12/31 23:59:59","timeZone":"UTC"},{"startTime":"2020/01/02 00:00:00","endTime":"2021/1/2 9:5:3","timeZone":"Asia/Shanghai"}]'
         WHEN c_custkey % 7 = 1 THEN ',"validitySchedules":[{"startTime":"2020/01/02 00:00:00","endTime":"2099/12/31 23:59:59","timeZone":""}]' ELSE '' END,
    '}') AS body
FROM customer
"""

# A column catalogue with at most 20 columns per table.
CATALOGUE = """
SELECT concat('tbl', CAST(CAST(floor(p_partkey / 20) AS BIGINT) AS STRING)) AS table_name,
       CAST(p_partkey % 20 AS INT) AS pos,
       concat('col_', CAST(p_partkey AS STRING)) AS column_name,
       lower(p_type) AS type
FROM part
"""

# Names to look up in the catalogues, some of them unknown.
NAMES = """
SELECT c_custkey, c_nationkey,
       CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'select' WHEN 1 THEN 'Create Table' WHEN 2 THEN 'nope'
         WHEN 3 THEN 'DELETE' WHEN 4 THEN 'resource group' ELSE '' END AS name
FROM customer
"""

# Every supplier stands for a service definition.
DEFINITIONS = """
SELECT CAST(s_suppkey AS INT) AS id,
       CASE CAST(s_suppkey % 8 AS INT) WHEN 0 THEN 'HIVE' WHEN 1 THEN 'hdfs' WHEN 2 THEN 'Cos' WHEN 3 THEN 'yarn'
         WHEN 4 THEN 'kms' WHEN 5 THEN 'CHDFS' WHEN 6 THEN 'kafka' ELSE 'tag' END AS name
FROM supplier
"""

# User records in which names repeat, and names to look up, some of them unknown.
USERS = """
SELECT concat('user', CAST(c_custkey % 700 AS STRING)) AS name, CAST(c_custkey AS INT) AS id, c_custkey AS seq
FROM customer
"""

LOOKUPS = """
SELECT o_orderkey, concat('user', CAST(o_custkey AS STRING)) AS name FROM orders
"""

# Text values for a load, some of which are no numbers.
RAW_LOAD = """
SELECT CAST(c_custkey AS STRING) AS c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'bad' ELSE CAST(CAST(c_acctbal AS INT) AS STRING) END AS c_acctbal,
       c_mktsegment
FROM customer
"""

# As many locations as parts and suppliers: pieces of folder names, and whole folders.
LOCATIONS_LARGE = """
SELECT concat('zone', CAST(p_partkey % 5 AS STRING), '/Tbl_', CAST(CAST(floor(p_partkey / 7) AS BIGINT) AS STRING)) AS pattern,
       concat('Part.P', CAST(p_partkey AS STRING)) AS table_name
FROM part
UNION ALL
SELECT concat('/ext/zone', CAST(s_suppkey % 5 AS STRING), '/tbl_', CAST(CAST(floor(s_suppkey / 3) AS BIGINT) AS STRING), '/raw'),
       concat('Supp.S', CAST(s_suppkey AS STRING))
FROM supplier
UNION ALL
SELECT concat('sales', CAST(p_partkey % 9 AS STRING), '.DB/tbl_', CAST(p_partkey AS STRING), '/dt='), concat('Sale.T', CAST(p_partkey AS STRING))
FROM part WHERE p_partkey % 3 = 0
"""

# Grants of which some cannot be read: names without a database, policies without one.
GRANTS_MIXED = """
SELECT c_custkey AS grant_id, 'default_catalog' AS catalog, concat('role', CAST(c_custkey % 6 AS STRING)) AS user_identity,
  CASE CAST(c_custkey % 5 AS INT)
    WHEN 0 THEN concat('GRANT SELECT ON TABLE nodot', CAST(c_custkey AS STRING), ' TO ROLE r')
    WHEN 1 THEN concat('grant apply on masking policy p', CAST(c_custkey AS STRING), ' to role r')
    WHEN 2 THEN concat('GRANT SELECT ON TABLE db', CAST(c_custkey % 7 AS STRING), '.t', CAST(c_custkey AS STRING), ' TO ROLE r')
    WHEN 3 THEN concat('GRANT USAGE ON FUNCTION f', CAST(c_custkey AS STRING), '(int) TO ROLE r')
    ELSE concat('GRANT ALTER ON ALL ROW ACCESS POLICIES IN DATABASE db', CAST(c_custkey % 7 AS STRING), ' TO ROLE r') END AS grant_sql
FROM customer
"""

# Statements run by users at a time, for a while.
USAGE_EVENTS = """
SELECT event_id AS query_id, user_id, CAST(user_id % 10 AS INT) AS team, ts AS run_at,
       ts + INTERVAL '1' MINUTE * CAST(floor(value) AS INT) AS done_at,
       concat('db', CAST(user_id % 4 AS STRING), '.t', CAST(event_id % 53 AS STRING)) AS table_name
FROM events
"""

# Versions of what each user was granted; the last one of a time counts.
GRANT_VERSIONS = """
SELECT o_orderkey AS grant_id, 'default_catalog' AS catalog, o_custkey % 150 AS user_id,
       CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ)
         + INTERVAL '18' MINUTE * CAST((year(o_orderdate) - 1995) * 372 + (month(o_orderdate) - 1) * 31 + day(o_orderdate) - 1 AS INT) AS valid_from,
       concat('u', CAST(o_custkey % 150 AS STRING), '@%') AS user_identity,
       concat('GRANT ', CASE WHEN o_orderkey % 3 = 0 THEN 'SELECT' WHEN o_orderkey % 3 = 1 THEN 'SELECT, INSERT' ELSE 'DELETE' END,
              ' ON TABLE db', CAST(o_orderkey % 7 AS STRING), '.t', CAST(o_orderkey AS STRING), ' TO USER x') AS grant_sql
FROM orders
"""

# Schedules of teams: short ones, some without an end, and one in 500 over all time.
SCHEDULES = """
SELECT c_custkey AS schedule_id, CAST(c_custkey % 10 AS INT) AS team,
       CASE WHEN c_custkey % 500 = 7 THEN NULL
            ELSE CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ) + INTERVAL '1' MINUTE * CAST((c_custkey * 7919) % 43200 AS INT) END AS valid_from,
       CASE WHEN c_custkey % 50 = 7 THEN NULL
            ELSE CAST('2024-01-01 00:00:00' AS TIMESTAMP_NTZ)
                 + INTERVAL '1' MINUTE * CAST((c_custkey * 7919) % 43200 + (c_custkey * 37) % 600 - 5 AS INT) END AS valid_until
FROM customer
"""

# Role and table grants: users have roles, roles have roles above them and, every tenth, their neighbour as well, which has them in turn.
ROLE_GRANTS = """
SELECT c_custkey AS grant_id, 'default_catalog' AS catalog, concat('u', CAST(c_custkey AS STRING), '@%') AS user_identity,
       concat('GRANT ', chr(39), 'r', CAST(c_custkey % 400 AS STRING), chr(39), ' TO USER x') AS grant_sql
FROM customer
UNION ALL
SELECT p_partkey, 'default_catalog', concat('r', CAST(p_partkey AS STRING)),
       concat('GRANT r', CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS STRING),
              CASE WHEN p_partkey % 10 = 0 THEN concat(', r', CAST(p_partkey + 1 AS STRING)) ELSE '' END, ' TO ROLE x')
FROM part
UNION ALL
SELECT p_partkey, 'default_catalog', concat('r', CAST(p_partkey + 1 AS STRING)),
       concat('GRANT r', CAST(p_partkey AS STRING), ' TO ROLE x')
FROM part WHERE p_partkey % 10 = 0
UNION ALL
SELECT p_partkey, 'default_catalog', concat('r', CAST(p_partkey AS STRING)),
       concat('GRANT SELECT, INSERT ON TABLE db', CAST(p_partkey % 7 AS STRING), '.t', CAST(p_partkey AS STRING), ' TO ROLE x')
FROM part WHERE p_partkey % 5 = 0
"""

# The listing some time later: rows went, sizes changed, and some rows are there twice.
LISTING_AFTER = f"""
SELECT a.name, a.atime, a.mtime, a.ctime, CASE WHEN a.size_byte % 7168 = 0 THEN a.size_byte + 1 ELSE a.size_byte END AS size_byte, a.type,
       a.acl, a.`user`, a.`group`, a.file_type, a.dt
FROM ({LISTING}) a WHERE a.size_byte <> 5120
UNION ALL
SELECT concat(b.name, '/new'), b.atime, b.mtime, b.ctime, b.size_byte, b.type, b.acl, b.`user`, b.`group`, b.file_type, b.dt
FROM ({LISTING}) b WHERE b.size_byte % 11264 = 0
UNION ALL
SELECT c.name, c.atime, c.mtime, c.ctime, c.size_byte, c.type, c.acl, c.`user`, c.`group`, c.file_type, c.dt
FROM ({LISTING}) c WHERE c.size_byte = 9216
"""

STATEMENTS = {
    "listing": LISTING, "locations": LOCATIONS, "querylog": QUERYLOG, "grants": GRANTS,
    "policies": POLICIES, "catalogue": CATALOGUE, "names": NAMES, "definitions": DEFINITIONS,
    "users": USERS, "lookups": LOOKUPS, "raw_load": RAW_LOAD, "usage_events": USAGE_EVENTS, "grants_mixed": GRANTS_MIXED, "locations_large": LOCATIONS_LARGE,
    "grant_versions": GRANT_VERSIONS, "schedules": SCHEDULES, "role_grants": ROLE_GRANTS, "listing_after": LISTING_AFTER,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A derived table in Spark, its base tables dealt over tasks if ``spread``. Views are resolved here, so later calls may replace them."""
    for base in TABLES:
        if f" {base}" in STATEMENTS[name]:
            rows = table(spark, sf_dir, base)
            (dealt(rows) if spread else rows).createOrReplaceTempView(base)
    return spark.sql(STATEMENTS[name])


def word_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole document, and the words of its lower-cased text."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.split("text", " ").alias("a"), F.split(F.lower("text"), " ").alias("b")
    )


def part_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map per part; small parts have no brand, large ones no kind."""
    full = F.create_map(
        F.lit("name"), F.col("p_name"),
        F.lit("brand"), F.when(F.col("p_size") >= 10, F.col("p_brand")),
        F.lit("type"), F.col("p_type"),
        F.lit("kind"), F.when(F.col("p_size") <= 40, F.col("p_type")),
        F.lit("size"), F.col("p_size").cast("string"),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.map_filter(full, lambda k, v: v.isNotNull()).alias("m")
    )


def tagged_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag catalogue with one field per part."""
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("pos"),
        F.concat(F.lit("Field"), key).alias("field_name"),
        F.col("p_type").alias("field_type"),
        F.create_map(
            F.lit("orm"), F.concat(F.lit("column:col_"), key, F.lit(",size:"), F.col("p_size").cast("string")),
            F.lit("json"), F.concat(F.lit("j"), key),
        ).alias("tags"),
    )
