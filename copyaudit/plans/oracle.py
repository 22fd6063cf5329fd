"""DuckDB SQL that recomputes each registered query from the same tables.

The SQL is written independently of the Spark code (plain CTEs over the
pre-registered views) so that a wrong Spark operator shows up as a mismatch.
Shared CTE text is assembled from the fragments below.
"""

from __future__ import annotations

# Fixed values shared with the catalogue (run parameters of the fixtures).
SRC_SYSTEM = "sys1"
COUNTRY = "sg"
SOURCE_PARENT = "/warehouse/tablespace/external/hive"
TARGET_PREFIX = "abfs://c@a.example/data/"
CONTAINER = "abfs://c@a.example"
STAGING_DIRS = ("/staging/open", "/staging/non_open", "/staging/storage")
CTRL_PATH = "/control"
STATUS_DIR = "/status"

WEIGHTS = """
ow AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS pd, o_orderdate AS d, o_orderkey AS k,
         1 AS w_source,
         CASE WHEN strftime(o_orderdate, '%Y-%m') = '1998-03' THEN 0
              WHEN month(o_orderdate) IN (2, 7) AND o_orderkey % 5 = 0 THEN 0
              WHEN month(o_orderdate) = 11 AND o_orderkey % 50 = 0 THEN 2
              ELSE 1 END AS w_target
  FROM orders),
lw AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS pd,
         1 AS w_source,
         CASE WHEN year(l_shipdate) = 1997 AND l_linenumber = 7 THEN 0 ELSE 1 END AS w_staging,
         CASE WHEN year(l_shipdate) = 1997 AND l_linenumber = 7 THEN 0
              WHEN month(l_shipdate) = 6 AND l_orderkey % 5 = 0 THEN 0
              ELSE 1 END AS w_target
  FROM lineitem),
ew AS (
  SELECT strftime(ts, '%Y-%m-%d') AS pd,
         1 AS w_source,
         CASE WHEN day(ts) % 10 = 0 AND event_id % 3 = 0 THEN 0 ELSE 1 END AS w_target
  FROM events)"""

COUNTS = """
counts AS (
  SELECT 'sri_open' AS db, 'orders' AS tbl, 'source' AS role, pd, CAST(sum(w_source) AS BIGINT) AS records FROM ow GROUP BY pd
  UNION ALL SELECT 'sri_open', 'orders', 'target', pd, CAST(sum(w_target) AS BIGINT) FROM ow GROUP BY pd
  UNION ALL SELECT 'sri_non_open', 'lineitem', 'source', pd, CAST(sum(w_source) AS BIGINT) FROM lw GROUP BY pd
  UNION ALL SELECT 'sri_non_open', 'lineitem', 'staging', pd, CAST(sum(w_staging) AS BIGINT) FROM lw GROUP BY pd
  UNION ALL SELECT 'sri_non_open', 'lineitem', 'target', pd, CAST(sum(w_target) AS BIGINT) FROM lw GROUP BY pd
  UNION ALL SELECT 'storage', 'events', 'source', pd, CAST(sum(w_source) AS BIGINT) FROM ew GROUP BY pd
  UNION ALL SELECT 'storage', 'events', 'target', pd, CAST(sum(w_target) AS BIGINT) FROM ew GROUP BY pd),
stats AS (
  SELECT db, tbl, role, pd, records,
         CAST(ceil(records / 64.0) AS BIGINT)
           + CASE WHEN role = 'staging' AND substr(pd, 6, 2) = '09' THEN 1 ELSE 0 END AS files,
         records * 100 AS bytes
  FROM counts WHERE records > 0),
work AS (
  SELECT db, tbl, pd FROM stats WHERE role = 'source'
  UNION ALL SELECT * FROM (VALUES ('sri_open', 'orders', '2002-01'), ('storage', 'events', '2025-01-01')) v(db, tbl, pd)),
aligned AS (
  SELECT w.db, w.tbl, w.pd,
         s.records AS s_rec, s.files AS s_files, s.bytes AS s_bytes, s.db IS NOT NULL AS s_present,
         g.records AS g_rec, g.files AS g_files, g.bytes AS g_bytes, g.db IS NOT NULL AS g_present,
         t.records AS t_rec, t.files AS t_files, t.bytes AS t_bytes, t.db IS NOT NULL AS t_present
  FROM work w
  LEFT JOIN stats s ON s.db = w.db AND s.tbl = w.tbl AND s.pd = w.pd AND s.role = 'source'
  LEFT JOIN stats g ON g.db = w.db AND g.tbl = w.tbl AND g.pd = w.pd AND g.role = 'staging'
  LEFT JOIN stats t ON t.db = w.db AND t.tbl = w.tbl AND t.pd = w.pd AND t.role = 'target')"""


def _two_way_items(tables: tuple[str, ...] = ("orders", "events")) -> str:
    in_list = ", ".join(f"'{t}'" for t in tables)
    return f"""
two_items AS (
  SELECT a.*,
         CASE a.db WHEN 'sri_open' THEN 'ods' WHEN 'sri_non_open' THEN 'nds' WHEN 'storage' THEN 'vds' END AS pcol,
         CASE WHEN NOT s_present THEN 'source_missing'
              WHEN NOT t_present THEN 'target_missing'
              ELSE 'compared' END AS state
  FROM aligned a WHERE a.tbl IN ({in_list})),
two_paths AS (
  SELECT *,
         '{SOURCE_PARENT}' || '/' || db || '/' || tbl || '/' || pcol || '=' || pd AS source_path
  FROM two_items),
two_rows AS (
  SELECT *,
         regexp_replace('{TARGET_PREFIX}', '/$', '')
           || regexp_replace(source_path, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '') AS target_path,
         CASE WHEN state = 'compared' THEN s_rec ELSE -1 END AS src_rec,
         CASE WHEN state = 'compared' THEN t_rec ELSE -1 END AS tgt_rec,
         CASE WHEN state = 'compared' THEN s_files ELSE -1 END AS src_files,
         CASE WHEN state = 'compared' THEN t_files ELSE -1 END AS tgt_files,
         CASE WHEN state = 'compared' THEN s_bytes ELSE -1 END AS src_bytes,
         CASE WHEN state = 'compared' THEN t_bytes ELSE -1 END AS tgt_bytes
  FROM two_paths)"""


def with_two_way(tail: str, tables: tuple[str, ...] = ("orders", "events")) -> str:
    return "WITH" + WEIGHTS + "," + COUNTS + "," + _two_way_items(tables) + "\n" + tail


THREE_ITEMS = f"""
three_items AS (
  SELECT a.*,
         CASE a.tbl WHEN 'lineitem' THEN 't' ELSE 'p' END AS ttype,
         CASE a.db WHEN 'sri_open' THEN 'ods' WHEN 'sri_non_open' THEN 'nds' WHEN 'storage' THEN 'vds'
                   ELSE 'None' END AS pcol,
         CASE a.db WHEN 'sri_open' THEN '{STAGING_DIRS[0]}' WHEN 'sri_non_open' THEN '{STAGING_DIRS[1]}'
                   WHEN 'storage' THEN '{STAGING_DIRS[2]}' ELSE '' END AS sdir
  FROM aligned a),
three_state AS (
  SELECT *,
         CASE WHEN NOT s_present THEN 'source_missing'
              WHEN ttype = 't' AND NOT g_present THEN 'staging_missing'
              WHEN NOT t_present THEN 'target_missing'
              ELSE 'compared' END AS state
  FROM three_items),
three_rows AS (
  SELECT *,
         '{CONTAINER}' || '{SOURCE_PARENT}' || '/' || db || '/' || tbl || '/' || pcol || '=' || pd AS source_path,
         CASE WHEN ttype = 'p' THEN 'Plain' ELSE sdir || '/' || tbl || '/' || pcol || '=' || pd END AS staging_path,
         '{SOURCE_PARENT}' || '/' || db || '/' || tbl || '/' || pcol || '=' || pd AS target_path,
         CASE WHEN state = 'compared' THEN s_rec ELSE -1 END AS src_rec,
         CASE WHEN state = 'compared' AND ttype = 't' THEN g_rec ELSE -1 END AS stg_rec,
         CASE WHEN state = 'compared' THEN t_rec ELSE -1 END AS tgt_rec,
         CASE WHEN state = 'compared' THEN s_files ELSE -1 END AS src_files,
         CASE WHEN state = 'compared' AND ttype = 't' THEN g_files ELSE -1 END AS stg_files,
         CASE WHEN state = 'compared' THEN t_files ELSE -1 END AS tgt_files,
         CASE WHEN state = 'compared' THEN s_bytes ELSE -1 END AS src_bytes,
         CASE WHEN state = 'compared' AND ttype = 't' THEN g_bytes ELSE -1 END AS stg_bytes,
         CASE WHEN state = 'compared' THEN t_bytes ELSE -1 END AS tgt_bytes
  FROM three_state),
three_verdict AS (
  SELECT *,
         CASE WHEN state = 'source_missing' THEN 'Done'
              WHEN state <> 'compared' THEN NULL
              WHEN ttype = 't' AND src_rec = stg_rec AND stg_rec = tgt_rec AND src_files = stg_files THEN 'Done'
              WHEN ttype = 'p' AND src_rec = tgt_rec THEN 'Done'
              ELSE 'Failed' END AS status,
         CASE WHEN state = 'source_missing' THEN 'Done'
              WHEN state <> 'compared' THEN NULL
              WHEN ttype = 't' AND src_rec = stg_rec AND stg_rec = tgt_rec AND src_files = stg_files THEN 'Done'
              WHEN ttype = 'p' AND src_rec = stg_rec AND src_rec = tgt_rec THEN 'Done'
              ELSE 'Failed' END AS literal_status
  FROM three_rows)"""


def with_three_way(tail: str) -> str:
    return "WITH" + WEIGHTS + "," + COUNTS + "," + THREE_ITEMS + "\n" + tail


def with_both(tail: str) -> str:
    return "WITH" + WEIGHTS + "," + COUNTS + "," + _two_way_items() + "," + THREE_ITEMS + "\n" + tail


# Argument lists of the work-list fixtures.
FIXTURE_DATABASES = "sri_open,sri_non_open,storage,other"
FIXTURE_TABLE_SPECS = '"orders|t,lineitem|p,events|t,bad|x,nosuffix"'
FIXTURE_TWO_WAY_TABLES = "orders,lineitem,events"
FIXTURE_MAP = " sri_open:ods,sri_non_open:nds,storage:vds"
PREFIX_VARIANTS = ("abfs://c@a.example/data/", "abfs://c@a.example/data", "abfs://c@a.example/data//")

PARTS = """
parts AS (
  SELECT DISTINCT 'orders' AS tbl, strftime(o_orderdate, '%Y-%m') AS pd FROM orders
  UNION ALL SELECT DISTINCT 'lineitem', strftime(l_shipdate, '%Y-%m') FROM lineitem
  UNION ALL SELECT DISTINCT 'events', strftime(ts, '%Y-%m-%d') FROM events)"""

FIXTURE_THREE_ITEMS = PARTS + f""",
d AS (SELECT unnest(string_split('{FIXTURE_DATABASES}', ',')) AS db),
t AS (SELECT unnest(string_split(replace('{FIXTURE_TABLE_SPECS}', '"', ''), ',')) AS table_spec),
pairs AS (
  SELECT db, table_spec, split_part(table_spec, '|', 1) AS tbl,
         lower(string_split(table_spec, '|')[-1]) AS ttype
  FROM d CROSS JOIN t),
items AS (
  SELECT pairs.*, parts.pd,
         CASE lower(db) WHEN 'sri_open' THEN 'ods' WHEN 'sri_non_open' THEN 'nds'
                        WHEN 'storage' THEN 'vds' ELSE 'None' END AS pcol,
         CASE WHEN ttype = 't' THEN
                CASE lower(db) WHEN 'sri_open' THEN '{STAGING_DIRS[0]}' WHEN 'sri_non_open' THEN '{STAGING_DIRS[1]}'
                               WHEN 'storage' THEN '{STAGING_DIRS[2]}' ELSE '' END
              WHEN ttype = 'p' THEN 'Plain' ELSE '' END AS sdir
  FROM pairs LEFT JOIN parts ON parts.tbl = pairs.tbl)"""

FIXTURE_TWO_ITEMS = PARTS + f""",
m_raw AS (
  SELECT unnest(string_split('{FIXTURE_MAP}', ',')) AS pair,
         unnest(generate_series(0, len(string_split('{FIXTURE_MAP}', ',')) - 1)) AS pos),
m AS (
  SELECT db_key, arg_max(pcol, pos) AS pcol FROM (
    SELECT lower(trim(split_part(pair, ':', 1))) AS db_key, split_part(pair, ':', 2) AS pcol, pos
    FROM m_raw WHERE len(string_split(pair, ':')) = 2) GROUP BY db_key),
d AS (SELECT unnest(string_split('{FIXTURE_DATABASES}', ',')) AS db),
t AS (SELECT unnest(string_split('{FIXTURE_TWO_WAY_TABLES}', ',')) AS tbl),
items2 AS (
  SELECT d.db, t.tbl, parts.pd, m.pcol,
         CASE WHEN m.pcol IS NOT NULL
              THEN '{SOURCE_PARENT}' || '/' || d.db || '/' || t.tbl || '/' || m.pcol || '=' || parts.pd END
           AS source_path
  FROM d CROSS JOIN t JOIN parts ON parts.tbl = t.tbl LEFT JOIN m ON m.db_key = lower(d.db))"""


def target_path_sql(prefix: str, source_path: str = "source_path") -> str:
    return (f"regexp_replace('{prefix}', '/$', '') || "
            f"regexp_replace({source_path}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', '')")


# The wide two-way audit: orders and events against three databases, one of
# them without a partition column; partitions are keyed by table only.
WIDE = f"""
wide_parts AS (
  SELECT tbl, pd FROM stats WHERE role = 'source' AND tbl IN ('orders', 'events')
  UNION ALL SELECT * FROM (VALUES ('orders', '2002-01'), ('events', '2025-01-01')) v(tbl, pd)),
wide_items AS (
  SELECT d.db, t.tbl, p.pd, m.pcol
  FROM (SELECT unnest(['sri_open', 'storage', 'other']) AS db) d
  CROSS JOIN (SELECT unnest(['orders', 'events']) AS tbl) t
  JOIN wide_parts p ON p.tbl = t.tbl
  LEFT JOIN (VALUES ('sri_open', 'ods'), ('sri_non_open', 'nds'), ('storage', 'vds')) m(db_key, pcol)
    ON m.db_key = lower(d.db)),
wide_state AS (
  SELECT w.*, s.records AS s_rec, x.records AS t_rec,
         CASE WHEN w.pcol IS NULL THEN 'lookup_missing'
              WHEN s.db IS NULL THEN 'source_missing'
              WHEN x.db IS NULL THEN 'target_missing'
              ELSE 'compared' END AS state,
         '{SOURCE_PARENT}' || '/' || w.db || '/' || w.tbl || '/' || w.pcol || '=' || w.pd AS source_path
  FROM wide_items w
  LEFT JOIN stats s ON s.db = w.db AND s.tbl = w.tbl AND s.pd = w.pd AND s.role = 'source'
  LEFT JOIN stats x ON x.db = w.db AND x.tbl = w.tbl AND x.pd = w.pd AND x.role = 'target'),
wide_failures AS (
  SELECT db, tbl, pd,
         CASE WHEN state = 'lookup_missing' THEN 'PartitionColumn' ELSE 'TargetListing' END AS stage,
         CASE WHEN state = 'lookup_missing' THEN 'failed to get Column Map for db ' || db
              ELSE 'path not found' END AS exception,
         'db: ' || db || ', table: ' || tbl || ', cause: ' ||
         CASE WHEN state = 'lookup_missing' THEN 'failed to get Column Map for db ' || db
              ELSE 'Failed to get information for target path: '
                   || {target_path_sql(TARGET_PREFIX)} || '; path not found' END AS message
  FROM wide_state WHERE state NOT IN ('compared', 'source_missing'))"""


def with_wide(tail: str) -> str:
    return "WITH" + WEIGHTS + "," + COUNTS + "," + WIDE + "\n" + tail


def with_wide_and_three(tail: str) -> str:
    return "WITH" + WEIGHTS + "," + COUNTS + "," + WIDE + "," + THREE_ITEMS + "\n" + tail
