"""Registered queries: each reads the driver's tables (or copies Spark derives
from them) and exercises a group of operators; ``ORACLES`` holds the DuckDB SQL
that recomputes the same rows.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.operators.worklist import ThreeWayParams, TwoWayParams
from copyaudit.plans import oracle as O
from copyaudit.plans import recipes
from copyaudit.plans.audits import Audit, audit_three_way, audit_two_way

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


# Run parameters of the fixtures.
PARTITION_MAP = " sri_open:ods,sri_non_open:nds,storage:vds"


def two_way_params(tables: str = "orders,events", databases: str = "sri_open,storage") -> TwoWayParams:
    return TwoWayParams(src_system=O.SRC_SYSTEM, country=O.COUNTRY, source_parent=O.SOURCE_PARENT,
                        target_prefix=O.TARGET_PREFIX, tables=tables, databases=databases,
                        partition_map=PARTITION_MAP)


def three_way_params(plain_rule: str = "source_target") -> ThreeWayParams:
    return ThreeWayParams(src_system=O.SRC_SYSTEM, country=O.COUNTRY, container=O.CONTAINER,
                          parent_dir=O.SOURCE_PARENT, open_staging_dir=O.STAGING_DIRS[0],
                          non_open_staging_dir=O.STAGING_DIRS[1], storage_staging_dir=O.STAGING_DIRS[2],
                          databases="sri_open,sri_non_open,storage",
                          tables='"orders|p,lineitem|t,events|p"', ctrl_path=O.CTRL_PATH,
                          plain_rule=plain_rule)


def derived_two_way(spark: SparkSession, sf_dir: str) -> Audit:
    rs = [recipes.ORDERS, recipes.EVENTS]
    stats = recipes.recipe_stats(spark, sf_dir, rs)
    return audit_two_way(spark, two_way_params(), recipes.work_partitions(spark, stats, rs), stats_rows=stats)


def derived_three_way(spark: SparkSession, sf_dir: str, plain_rule: str = "source_target") -> Audit:
    rs = [recipes.ORDERS, recipes.LINEITEM, recipes.EVENTS]
    stats = recipes.recipe_stats(spark, sf_dir, rs)
    return audit_three_way(spark, three_way_params(plain_rule), recipes.work_partitions(spark, stats, rs),
                           stats_rows=stats)


TWO_WAY_RESULT_SQL = O.with_two_way("""
SELECT '%s' AS SrcSystem, '%s' AS Country, db AS SchemaName, tbl AS TableName,
       src_rec AS SourcePartRecordCount, tgt_rec AS TargetPartRecordCount,
       src_files AS SourcePartFileCount, tgt_files AS TargetPartFileCount,
       src_bytes AS SourcePartSize, tgt_bytes AS TargetPartSize,
       source_path AS SourcePath,
       CASE WHEN state = 'source_missing' THEN '' ELSE target_path END AS TargetPath,
       CASE WHEN state = 'source_missing' OR src_rec = tgt_rec THEN 'Done' ELSE 'Failed' END AS Status,
       pd AS partition_date
FROM two_rows WHERE state IN ('compared', 'source_missing')""" % (O.SRC_SYSTEM, O.COUNTRY))


@query("q16_two_way_result", TWO_WAY_RESULT_SQL)
def q16_two_way_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full 14-column two-way result of orders and events."""
    return derived_two_way(spark, sf_dir).results


THREE_WAY_RESULT_SQL = O.with_three_way("""
SELECT '%s' AS SrcSystem, '%s' AS Country, db AS SchemaName, tbl AS TableName,
       src_rec AS SourcePartRecordCount, stg_rec AS StagingPartRecordCount, tgt_rec AS TargetPartRecordCount,
       src_files AS SourcePartFileCount, stg_files AS StagingPartFileCount, tgt_files AS TargetPartFileCount,
       src_bytes AS SourcePartSize, stg_bytes AS StagingPartSize, tgt_bytes AS TargetPartSize,
       source_path AS SourcePath, staging_path AS StagingPath, target_path AS TargetPath,
       status AS Status, pd AS partition_date
FROM three_verdict WHERE state IN ('compared', 'source_missing')""" % (O.SRC_SYSTEM, O.COUNTRY))


@query("q17_three_way_result", THREE_WAY_RESULT_SQL)
def q17_three_way_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full 18-column three-way result of all three tables."""
    return derived_three_way(spark, sf_dir).results


MULTI_TABLE_SQL = O.with_three_way("""
SELECT db AS SchemaName, tbl AS TableName, pd AS partition_date,
       src_rec AS SourcePartRecordCount, stg_rec AS StagingPartRecordCount, tgt_rec AS TargetPartRecordCount,
       CASE WHEN state = 'compared' THEN status ELSE state END AS outcome
FROM three_verdict""")


@query("q27_multi_table_audit", MULTI_TABLE_SQL)
def q27_multi_table_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 J3 at scale: every partition of every table, one union, one groupBy."""
    v = derived_three_way(spark, sf_dir).verdicts
    return v.select(
        F.col("db").alias("SchemaName"), F.col("table").alias("TableName"), "partition_date",
        F.col("source_records_out").alias("SourcePartRecordCount"),
        F.col("staging_records_out").alias("StagingPartRecordCount"),
        F.col("target_records_out").alias("TargetPartRecordCount"),
        F.when(F.col("state") == "compared", F.col("Status")).otherwise(F.col("state")).alias("outcome"))


# ---------------------------------------------------------------- physical copies

_WRITTEN: dict[tuple, tuple] = {}       # copies already written by this application, per table folder


def _written_once(spark: SparkSession, sf_dir: str, kind: str, tables: list, params, layout_of, emptied=None):
    from copyaudit.plans import physical
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _WRITTEN:
        parts = recipes.work_items(spark, sf_dir, tables).checkpoint(eager=True)
        layout = layout_of(spark, kind, params)
        physical.write_copies(spark, sf_dir, layout, parts, tables)
        if emptied:
            physical.empty_sources(spark, layout, parts, emptied)
        _WRITTEN[key] = layout, parts
    return _WRITTEN[key]


def _physical_two_way(spark: SparkSession, sf_dir: str):
    from copyaudit.plans import physical
    return _written_once(spark, sf_dir, "two-way", [recipes.ORDERS, recipes.EVENTS], two_way_params(),
                         physical.two_way_layout)


def _physical_three_way(spark: SparkSession, sf_dir: str):
    from copyaudit.plans import physical
    return _written_once(spark, sf_dir, "three-way", [recipes.ORDERS, recipes.LINEITEM, recipes.EVENTS],
                         three_way_params(), physical.three_way_layout)


@query("q01_partition_record_count", """
SELECT 'sri_open' AS db, 'orders' AS "table", 'source' AS role,
       strftime(o_orderdate, '%Y-%m') AS partition_date, count(*) AS records
FROM orders GROUP BY 4""")
def q01_partition_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as ORC by month, read back from its root, counted."""
    from copyaudit.operators.worklist import copy_locations, two_way_work_list
    from copyaudit.sources.copies import copy_counts, scan_copies
    layout, parts = _physical_two_way(spark, sf_dir)
    work = two_way_work_list(spark, layout.two_way, parts)
    locs = [loc for loc in copy_locations(work.tables, ["source"]) if (loc.db, loc.table) == ("sri_open", "orders")]
    rows, _ = scan_copies(spark, locs)
    return copy_counts(rows).select("db", "table", "role", "partition_date", "records")


@query("q02_avro_partition_count", """
SELECT 'storage' AS db, 'events' AS "table", 'avro' AS data_format,
       strftime(ts, '%Y-%m-%d') AS partition_date, count(*) AS records
FROM events GROUP BY 4""")
def q02_avro_partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events routed to Avro by its database, written by day, counted."""
    from copyaudit.operators.worklist import copy_locations, three_way_work_list
    from copyaudit.sources.copies import copy_counts, scan_copies
    layout, parts = _physical_three_way(spark, sf_dir)
    work = three_way_work_list(spark, layout.three_way, parts)
    locs = [loc for loc in copy_locations(work.tables, ["source"]) if (loc.db, loc.table) == ("storage", "events")]
    rows, _ = scan_copies(spark, locs)
    fmt = F.lit(locs[0].fmt) if locs else F.lit(None).cast("string")
    return copy_counts(rows).select("db", "table", fmt.alias("data_format"), "partition_date", "records")


@query("q03_file_listing", """
SELECT parse_filename(filename) AS file_name, size AS bytes
FROM read_blob('/root/testdata/sf0.01/*.parquet')""")
def q03_file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat listing of the table files (names and sizes, contents unread)."""
    from copyaudit.sources.inventory import file_listing
    return file_listing(spark, sf_dir, glob="*.parquet").select("file_name", F.col("length").alias("bytes"))


@query("q04_folder_totals", """
SELECT regexp_extract(filename, '([^/]+)/[^/]+$', 1) AS folder_name, count(*) AS files,
       CAST(sum(size) AS BIGINT) AS bytes
FROM read_blob('/root/testdata/sf0.01/*') GROUP BY 1""")
def q04_folder_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive listing, files and bytes per folder."""
    from copyaudit.functions.paths import file_name
    from copyaudit.sources.inventory import file_listing, folder_totals
    totals = folder_totals(file_listing(spark, sf_dir, recursive=True))
    return totals.select(file_name("folder").alias("folder_name"), "files", "bytes")


@query("q12_two_way_verdict", O.with_two_way("""
SELECT db AS SchemaName, tbl AS TableName, pd AS partition_date,
       src_rec AS SourcePartRecordCount, tgt_rec AS TargetPartRecordCount,
       CASE WHEN state = 'compared' THEN 1 ELSE -1 END AS SourcePartFileCount,
       CASE WHEN state = 'compared' THEN 1 ELSE -1 END AS TargetPartFileCount,
       CASE WHEN state = 'source_missing' OR (state = 'compared' AND src_rec = tgt_rec) THEN 'Done'
            WHEN state = 'compared' THEN 'Failed' END AS Status,
       state
FROM two_rows"""))
def q12_two_way_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written ORC copies, counted from their paths, aligned, judged; one file per partition."""
    layout, parts = _physical_two_way(spark, sf_dir)
    v = audit_two_way(spark, layout.two_way, parts).verdicts
    return v.select(F.col("db").alias("SchemaName"), F.col("table").alias("TableName"), "partition_date",
                    F.col("source_records_out").alias("SourcePartRecordCount"),
                    F.col("target_records_out").alias("TargetPartRecordCount"),
                    F.col("source_files_out").alias("SourcePartFileCount"),
                    F.col("target_files_out").alias("TargetPartFileCount"), "Status", "state")


@query("q28_all_dates_all_pairs", O.with_two_way("""
SELECT d.db AS SchemaName, t.tbl AS TableName, p.pd AS partition_date,
       coalesce(r.src_rec, -1) AS SourcePartRecordCount, coalesce(r.tgt_rec, -1) AS TargetPartRecordCount,
       CASE WHEN r.state IS NULL OR r.state = 'source_missing' OR r.src_rec = r.tgt_rec THEN 'Done' ELSE 'Failed' END AS Status
FROM (VALUES ('sri_open'), ('storage')) d(db)
CROSS JOIN (VALUES ('orders'), ('events')) t(tbl)
CROSS JOIN (SELECT DISTINCT pd FROM two_rows) p
LEFT JOIN two_rows r ON r.db = d.db AND r.tbl = t.tbl AND r.pd = p.pd
WHERE r.state IS NULL OR r.state IN ('compared', 'source_missing')"""))
def q28_all_dates_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that names its dates: every date for every (db, table), read from the paths, checked."""
    layout, parts = _physical_two_way(spark, sf_dir)
    dates = sorted(r[0] for r in parts.select("partition_date").distinct().collect())
    return audit_two_way(spark, layout.two_way, dates).results.select(
        "SchemaName", "TableName", "partition_date", "SourcePartRecordCount", "TargetPartRecordCount", "Status")


@query("q13_missing_source", O.with_both("""
SELECT 'two_way' AS audit, db AS SchemaName, tbl AS TableName, pd AS partition_date,
       src_rec AS SourcePartRecordCount, tgt_rec AS TargetPartRecordCount, src_files AS SourcePartFileCount,
       tgt_bytes AS TargetPartSize, source_path AS SourcePath, '' AS TargetPath, 'Done' AS Status
FROM two_rows WHERE state = 'source_missing'
UNION ALL
SELECT 'three_way', db, tbl, pd, src_rec, tgt_rec, src_files, tgt_bytes, source_path, target_path, status
FROM three_verdict WHERE state = 'source_missing'"""))
def q13_missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent source partitions give -1 counters and Done."""
    cols = ["SchemaName", "TableName", "partition_date", "SourcePartRecordCount", "TargetPartRecordCount",
            "SourcePartFileCount", "TargetPartSize", "SourcePath", "TargetPath", "Status"]
    two = derived_two_way(spark, sf_dir).verdicts.where(F.col("state") == "source_missing")
    three = derived_three_way(spark, sf_dir).verdicts.where(F.col("state") == "source_missing")
    two_rows = R_two(two).select(F.lit("two_way").alias("audit"), *cols)
    three_rows = R_three(three).select(F.lit("three_way").alias("audit"), *cols)
    return two_rows.unionByName(three_rows)


def R_two(verdicts):
    from copyaudit.operators.results import two_way_results
    return two_way_results(verdicts)


def R_three(verdicts):
    from copyaudit.operators.results import three_way_results
    return three_way_results(verdicts)


@query("q14_three_way_verdict", O.with_three_way(f"""
SELECT db AS SchemaName, tbl AS TableName, pd AS partition_date, src_rec AS SourcePartRecordCount,
       stg_rec AS StagingPartRecordCount, tgt_rec AS TargetPartRecordCount, n_src AS SourcePartFileCount,
       n_stg AS StagingPartFileCount, n_tgt AS TargetPartFileCount,
       CASE WHEN state = 'source_missing' THEN 'Done' WHEN state <> 'compared' THEN NULL
            WHEN ttype = 't' AND src_rec = stg_rec AND stg_rec = tgt_rec AND n_src = n_stg THEN 'Done'
            WHEN ttype = 'p' AND src_rec = tgt_rec THEN 'Done' ELSE 'Failed' END AS Status,
       state
FROM (SELECT *, CASE WHEN state = 'compared' THEN 1 ELSE -1 END AS n_src,
             CASE WHEN state = 'compared' AND ttype = 't'
                  THEN CASE WHEN substr(pd, 6, 2) = '{recipes.EXTRA_STAGING_FILE_MONTH}' THEN 2 ELSE 1 END ELSE -1 END AS n_stg,
             CASE WHEN state = 'compared' THEN 1 ELSE -1 END AS n_tgt
      FROM three_rows)"""))
def q14_three_way_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORC and Avro copies incl. staging, counted from paths, aligned and judged.

    Every partition holds one file, and some staging partitions an empty second one.
    """
    layout, parts = _physical_three_way(spark, sf_dir)
    v = audit_three_way(spark, layout.three_way, parts).verdicts
    counts = [F.col(f"{role}_{what}_out").alias(f"{role.title()}Part{name}Count")
              for role in ("source", "staging", "target") for what, name in (("records", "Record"), ("files", "File"))]
    return v.select(F.col("db").alias("SchemaName"), F.col("table").alias("TableName"), "partition_date", *counts,
                    "Status", "state")


@query("q29_partition_bytes", """
SELECT 'sri_open' AS db, 'orders' AS "table", role, strftime(o_orderdate, '%Y-%m') AS partition_date, true AS bytes_match
FROM orders, (VALUES ('source'), ('target')) r(role)
WHERE role = 'source' OR (strftime(o_orderdate, '%Y-%m') <> '1998-03'
  AND NOT (month(o_orderdate) IN (2, 7) AND o_orderkey % 5 = 0)) GROUP BY ALL
UNION ALL
SELECT 'storage', 'events', role, strftime(ts, '%Y-%m-%d'), true
FROM events, (VALUES ('source'), ('target')) r(role)
WHERE role = 'source' OR NOT (day(ts) % 10 = 0 AND event_id % 3 = 0) GROUP BY ALL""")
def q29_partition_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and files of every written partition, as Spark's own file reader has them."""
    from copyaudit.operators.worklist import copy_locations, two_way_work_list
    from copyaudit.sources.copies import copy_files
    layout, parts = _physical_two_way(spark, sf_dir)
    work = two_way_work_list(spark, layout.two_way, parts)
    locs = [loc for loc in copy_locations(work.tables, ["source", "target"])
            if (loc.db, loc.table) in (("sri_open", "orders"), ("storage", "events"))]
    files, _ = copy_files(spark, locs)
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([loc.root for loc in locs]) \
        .select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), F.col("length").alias("read_length"))
    keys = ["db", "table", "role", "partition_date"]
    return files.where("path IS NOT NULL").join(seen, "path", "full").groupBy(*keys).agg(
        ((F.sum("length") == F.sum("read_length")) & (F.count("length") == F.count("read_length")) & (F.min("length") > 0))
        .alias("bytes_match"))


EMPTIED = {"04": False, "06": True}      # months whose source directories are emptied; whether ``_SUCCESS`` stays


@query("q30_emptied_source", O.with_both("""
SELECT 'two_way' AS audit, db AS SchemaName, tbl AS TableName, pd AS partition_date,
       CASE WHEN state = 'source_missing' THEN 'Done'
            WHEN state <> 'compared' OR substr(pd, 6, 2) IN ('04', '06') THEN 'failure'
            WHEN src_rec = tgt_rec THEN 'Done' ELSE 'Failed' END AS outcome,
       state = 'source_missing' OR (state = 'compared' AND substr(pd, 6, 2) NOT IN ('04', '06')) AS control
FROM two_rows WHERE tbl = 'orders'
UNION ALL
SELECT 'three_way', db, tbl, pd,
       CASE WHEN state = 'source_missing' THEN 'Done'
            WHEN state <> 'compared' OR substr(pd, 6, 2) IN ('04', '06') THEN 'failure' ELSE status END,
       state = 'compared' AND substr(pd, 6, 2) NOT IN ('04', '06')
FROM three_verdict WHERE tbl = 'orders'"""))
def q30_emptied_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source directories that are there without data give failures, never ``Done`` and never a control record."""
    from copyaudit.plans import physical
    out = []
    for audit, kind, params, layout_of in (
            (audit_two_way, "two_way", two_way_params("orders", "sri_open"), physical.two_way_layout),
            (audit_three_way, "three_way", three_way_params(), physical.three_way_layout)):
        if kind == "three_way":
            params.databases, params.tables = "sri_open", "orders|p"
        layout, parts = _written_once(spark, sf_dir, f"{kind}-emptied", [recipes.ORDERS], params, layout_of, EMPTIED)
        done = audit(spark, layout.two_way or layout.three_way, parts)
        keys = ["db", "table", "partition_date"]
        controls = done.controls.select(*keys, F.lit(True).alias("control"))
        outcome = F.when(F.col("state").isin("compared", "source_missing"), F.col("Status")).otherwise(F.lit("failure"))
        out.append(done.verdicts.join(controls, keys, "left").select(
            F.lit(kind).alias("audit"), F.col("db").alias("SchemaName"), F.col("table").alias("TableName"), "partition_date",
            outcome.alias("outcome"), F.coalesce("control", F.lit(False)).alias("control")))
    return out[0].unionByName(out[1])


@query("q15_plain_verdict", O.with_three_way("""
SELECT db AS SchemaName, tbl AS TableName, pd AS partition_date,
       status AS status_source_target, literal_status AS status_literal
FROM three_verdict WHERE ttype = 'p' AND state IN ('compared', 'source_missing')"""))
def q15_plain_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """plain tables under both rules (source = target, and the literal one)."""
    from copyaudit.operators.verdict import three_way_status
    v = derived_three_way(spark, sf_dir).verdicts
    return (v.where((F.col("table_type") == "p") & F.col("state").isin("compared", "source_missing"))
            .select(F.col("db").alias("SchemaName"), F.col("table").alias("TableName"), "partition_date",
                    three_way_status("source_target").alias("status_source_target"),
                    three_way_status("literal").alias("status_literal")))


# ---------------------------------------------------------------- work lists, routing, paths

def fixture_three_way_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = three_way_params()
    p.databases, p.tables = O.FIXTURE_DATABASES, O.FIXTURE_TABLE_SPECS
    from copyaudit.operators.worklist import three_way_work_list
    return three_way_work_list(spark, p, recipes.source_partitions(spark, sf_dir), partition_join="left").items


def fixture_two_way_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from copyaudit.operators.worklist import two_way_work_list
    p = two_way_params(tables=O.FIXTURE_TWO_WAY_TABLES, databases=O.FIXTURE_DATABASES)
    p.partition_map = O.FIXTURE_MAP
    return two_way_work_list(spark, p, recipes.source_partitions(spark, sf_dir)).items


@query("q05_work_list", "WITH" + O.FIXTURE_THREE_ITEMS + """
SELECT db, table_spec, tbl AS "table", pd AS partition_date FROM items""")
def q05_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Argument lists -> db x table pairs -> one item per data partition."""
    return fixture_three_way_items(spark, sf_dir).select("db", "table_spec", "table", "partition_date")


@query("q06_partition_col_lookup", "WITH" + O.FIXTURE_TWO_ITEMS + """
SELECT db, tbl AS "table", pd AS partition_date, pcol AS partition_col, pcol IS NOT NULL AS found
FROM items2""")
def q06_partition_col_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Db -> partition column map joined to the work list."""
    items = fixture_two_way_items(spark, sf_dir)
    return items.select("db", "table", "partition_date", "partition_col",
                        F.col("partition_col").isNotNull().alias("found"))


@query("q07_partition_col_case", "WITH" + O.FIXTURE_THREE_ITEMS + f"""
SELECT db, table_spec, pd AS partition_date, pcol AS partition_col,
       concat_ws('/', '{O.CONTAINER}' || '{O.SOURCE_PARENT}' || '/' || db || '/' || tbl, pcol || '=' || pd)
         AS source_path,
       concat_ws('/', '{O.SOURCE_PARENT}' || '/' || db || '/' || tbl, pcol || '=' || pd) AS target_path
FROM items""")
def q07_partition_col_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed partition-column CASE and the three-way partition paths."""
    return fixture_three_way_items(spark, sf_dir).select(
        "db", "table_spec", "partition_date", "partition_col", "source_path", "target_path")


@query("q08_table_spec", "WITH" + O.FIXTURE_THREE_ITEMS + """
SELECT db, table_spec, tbl AS "table", ttype AS table_type, ttype IN ('t', 'p') AS valid_type,
       pd AS partition_date
FROM items""")
def q08_table_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes stripped, ``name|type`` split, type checked."""
    return fixture_three_way_items(spark, sf_dir).select(
        "db", "table_spec", "table", "table_type", "valid_type", "partition_date")


@query("q09_staging_route", "WITH" + O.FIXTURE_THREE_ITEMS + """
SELECT db, table_spec, pd AS partition_date, sdir AS staging_dir,
       CASE WHEN sdir = 'Plain' THEN 'Plain' ELSE concat_ws('/', sdir, tbl, pcol || '=' || pd) END
         AS staging_path
FROM items""")
def q09_staging_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging root by (type, db) and the staging partition path."""
    return fixture_three_way_items(spark, sf_dir).select(
        "db", "table_spec", "partition_date", "staging_dir", "staging_path")


@query("q10_format_route", "WITH" + O.FIXTURE_THREE_ITEMS + """
SELECT db, table_spec, pd AS partition_date,
       CASE WHEN lower(db) LIKE '%storage%' THEN 'avro' ELSE 'orc' END AS data_format
FROM items""")
def q10_format_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: Avro for databases named like storage, ORC otherwise."""
    return fixture_three_way_items(spark, sf_dir).select("db", "table_spec", "partition_date", "data_format")


@query("q11_paths", "WITH" + O.FIXTURE_TWO_ITEMS + f"""
SELECT db, tbl AS "table", pd AS partition_date, source_path,
       {O.target_path_sql(O.PREFIX_VARIANTS[0])} AS target_path_slash,
       {O.target_path_sql(O.PREFIX_VARIANTS[1])} AS target_path_plain,
       {O.target_path_sql(O.PREFIX_VARIANTS[2])} AS target_path_double
FROM items2""")
def q11_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source partition path and target path for three prefix spellings."""
    from copyaudit.functions.paths import target_partition_path
    items = fixture_two_way_items(spark, sf_dir)
    names = ["target_path_slash", "target_path_plain", "target_path_double"]
    return items.select("db", "table", "partition_date", "source_path",
                        *[target_partition_path(F.lit(p), "source_path").alias(n)
                          for p, n in zip(O.PREFIX_VARIANTS, names)])


# ---------------------------------------------------------------- failures, sinks, registration

def wide_two_way(spark: SparkSession, sf_dir: str) -> Audit:
    """Two-way audit of orders and events against sri_open, storage and other."""
    rs = [recipes.ORDERS, recipes.EVENTS]
    stats = recipes.recipe_stats(spark, sf_dir, rs)
    parts = recipes.work_items(spark, sf_dir, rs, by_db=False)
    return audit_two_way(spark, two_way_params(databases="sri_open,storage,other"), parts, stats_rows=stats)


def _scan_errors(stats: DataFrame) -> DataFrame:
    """Scan errors of single partitions of orders: sources of every April, targets of every May."""
    month = F.substring("partition_date", 6, 2)
    rows = stats.where((F.col("table") == "orders") & (((F.col("role") == "source") & (month == "04"))
                                                       | ((F.col("role") == "target") & (month == "05"))))
    return rows.select("db", "table", "role", "partition_date", F.concat(F.lit("unreadable "), "role").alias("exception"))


@query("q26_failure_quarantine", O.with_wide_and_three("""
SELECT 'two_way' AS audit, db, tbl AS "table", pd AS partition_date,
       CASE WHEN state = 'lookup_missing' THEN 'PartitionColumn'
            WHEN tbl = 'orders' AND db = 'sri_open' AND substr(pd, 6, 2) = '04' THEN 'SourceSize'
            WHEN tbl = 'orders' AND db = 'sri_open' AND substr(pd, 6, 2) = '05' THEN 'TargetListing'
            WHEN state IN ('compared', 'source_missing') THEN 'result' ELSE 'TargetListing' END AS disposition
FROM wide_state
UNION ALL
SELECT 'three_way', db, tbl, pd,
       CASE WHEN state = 'source_missing' THEN 'result'
            WHEN tbl = 'orders' AND substr(pd, 6, 2) = '04' THEN 'FileCount'
            WHEN tbl = 'lineitem' OR tbl = 'orders' AND substr(pd, 6, 2) = '05' THEN 'ComputeStats'
            WHEN state = 'compared' THEN 'result' ELSE 'ComputeStats' END
FROM three_rows"""))
def q26_failure_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item is a result row or a failure row, never both; taken from the two sinks' frames."""
    rs = [recipes.ORDERS, recipes.EVENTS]
    stats = recipes.recipe_stats(spark, sf_dir, rs)
    two = audit_two_way(spark, two_way_params(databases="sri_open,storage,other"),
                        recipes.work_items(spark, sf_dir, rs, by_db=False), stats_rows=stats,
                        root_errors=_scan_errors(stats)).materialized()
    rs = [recipes.ORDERS, recipes.LINEITEM, recipes.EVENTS]
    stats = recipes.recipe_stats(spark, sf_dir, rs)
    params = three_way_params()
    params.tables = params.tables.replace("lineitem|t", "lineitem|x")            # a type that is neither t nor p
    three = audit_three_way(spark, params, recipes.work_partitions(spark, stats, rs), stats_rows=stats,
                            root_errors=_scan_errors(stats)).materialized()
    out = None
    for name, audit in (("two_way", two), ("three_way", three)):
        kept = audit.results.select(F.lit(name).alias("audit"), F.col("SchemaName").alias("db"),
                                    F.col("TableName").alias("table"), "partition_date", F.lit("result").alias("disposition"))
        held = audit.failures.where(F.col("db").isNotNull()).select(
            F.lit(name).alias("audit"), "db", "table", "partition_date", F.col("stage").alias("disposition"))
        both = kept.unionByName(held)
        out = both if out is None else out.unionByName(both)
    return out


@query("q23_failure_rows", O.with_wide_and_three("""
SELECT 'two_way' AS audit, stage, db, tbl AS "table", pd AS partition_date, message, exception
FROM wide_failures
UNION ALL
SELECT 'three_way', 'ComputeStats', db, tbl, pd,
       'ComputeStats failed for table ' || db || '.' || tbl || ' due to target path not found: ' || target_path,
       'target path not found: ' || target_path
FROM three_rows WHERE state = 'target_missing'"""))
def q23_failure_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure rows of both audits, written as CSV and read back."""
    from copyaudit.session import scratch_path
    from copyaudit.sinks.files import read_failures, write_failures
    base = scratch_path(spark, "q23")
    out = None
    for name, audit in (("two_way", wide_two_way(spark, sf_dir)), ("three_way", derived_three_way(spark, sf_dir))):
        done, path = audit.materialized(), f"{base}/{name}"
        orders = F.col("table") == "orders"
        # a run over all tables, then runs over some: each replaces its own keys only
        for run in (F.lit(True), orders, ~orders):
            write_failures(done.failures.where(run), path, audited=done.verdicts.where(run))
        back = read_failures(spark, f"{base}/{name}").select(
            F.lit(name).alias("audit"), "stage", "db", "table", "partition_date", "message", "exception")
        out = back if out is None else out.unionByName(back)
    return out


# The run date of the summary fixture (P21 formats it).
RUN_DATE = "2022-03-01"


@query("q24_run_summary", O.with_wide_and_three(f"""
SELECT 'two_way' AS audit, count(*) AS items,
       count(*) FILTER (WHERE state = 'compared' AND s_rec = t_rec) AS done,
       count(*) FILTER (WHERE state = 'compared' AND s_rec <> t_rec) AS failed,
       count(*) FILTER (WHERE state = 'source_missing') AS source_missing,
       count(*) FILTER (WHERE state NOT IN ('compared', 'source_missing')) AS errors,
       CASE WHEN count(*) FILTER (WHERE state NOT IN ('compared', 'source_missing')) > 0 THEN 1 ELSE 0 END
         AS exit_code,
       strftime(DATE '{RUN_DATE}', '%Y%m%d') AS run_date
FROM wide_state
UNION ALL
SELECT 'three_way', count(*),
       count(*) FILTER (WHERE state = 'compared' AND status = 'Done'),
       count(*) FILTER (WHERE status = 'Failed'),
       count(*) FILTER (WHERE state = 'source_missing'),
       count(*) FILTER (WHERE state NOT IN ('compared', 'source_missing')),
       CASE WHEN count(*) FILTER (WHERE state NOT IN ('compared', 'source_missing')) > 0 THEN 1 ELSE 0 END,
       strftime(DATE '{RUN_DATE}', '%Y%m%d')
FROM three_verdict"""))
def q24_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome counts and exit code per audit run."""
    run_date = F.date_format(F.to_date(F.lit(RUN_DATE)), "yyyyMMdd").alias("run_date")
    two = wide_two_way(spark, sf_dir).materialized().summary.select(F.lit("two_way").alias("audit"), "*", run_date)
    three = derived_three_way(spark, sf_dir).materialized().summary.select(F.lit("three_way").alias("audit"), "*", run_date)
    return two.unionByName(three)


@query("q19_control_records", O.with_both(f"""
SELECT 'two_way' AS audit,
       regexp_replace('{O.TARGET_PREFIX}', '/$', '') || '/{O.SRC_SYSTEM}/{O.COUNTRY}/' || db AS control_dir,
       db || '_' || tbl || '_' || pd || '.' || CASE WHEN src_rec = tgt_rec THEN 'match' ELSE 'nonmatch' END
         AS control_name,
       CASE WHEN src_rec = tgt_rec THEN 'match' ELSE 'nonmatch' END AS outcome,
       pd AS partition_date
FROM two_rows WHERE state IN ('compared', 'source_missing')
UNION ALL
SELECT 'three_way', '{O.CTRL_PATH}/global',
       db || '_' || tbl || '_' || pd || '.' || CASE WHEN status = 'Done' THEN 'match' ELSE 'nonmatch' END,
       CASE WHEN status = 'Done' THEN 'match' ELSE 'nonmatch' END, pd
FROM three_verdict WHERE state = 'compared'"""))
def q19_control_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control records written per partition_date and read back."""
    from copyaudit.session import scratch_path
    from copyaudit.sinks.files import read_controls, write_controls
    base = scratch_path(spark, "q19")
    out = None
    for name, audit in (("two_way", derived_two_way(spark, sf_dir)), ("three_way", derived_three_way(spark, sf_dir))):
        done, orders = audit.materialized(), F.col("table") == "orders"
        stale = done.controls.withColumn("outcome", F.lit("stale"))
        # a run whose rows are all replaced by the two runs after it, each over some of the tables
        write_controls(stale, f"{base}/{name}", audited=done.verdicts)
        write_controls(done.controls.where(orders), f"{base}/{name}", audited=done.verdicts.where(orders))
        write_controls(done.controls.where(~orders), f"{base}/{name}", audited=done.verdicts.where(~orders))
        back = read_controls(spark, f"{base}/{name}").select(
            F.lit(name).alias("audit"), "control_dir", "control_name", "outcome", "partition_date")
        out = back if out is None else out.unionByName(back)
    return out


@query("q18_result_append", O.with_both("""
SELECT 'two_way' AS result_table, CASE WHEN state = 'source_missing' OR src_rec = tgt_rec THEN 'Done'
       ELSE 'Failed' END AS Status, 2 * count(*) AS rows
FROM two_rows WHERE state IN ('compared', 'source_missing') GROUP BY 1, 2
UNION ALL
SELECT 'three_way', status, 2 * count(*) FROM three_verdict
WHERE state IN ('compared', 'source_missing') GROUP BY 1, 2"""))
def q18_result_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the result tables, append a run twice, read back."""
    import uuid
    from copyaudit.session import scratch_path
    from copyaudit.sinks.tables import append_results, create_result_table
    suffix = uuid.uuid4().hex[:10]
    base = scratch_path(spark, "q18")
    out = None
    for name, audit, three in (("two_way", derived_two_way(spark, sf_dir), False),
                               ("three_way", derived_three_way(spark, sf_dir), True)):
        table = create_result_table(spark, "copyaudit_results", f"{name}_{suffix}", three,
                                    location=f"{base}/{name}", database_location=f"{base}/db")
        done = audit.materialized()
        append_results(done.results, table)
        append_results(done.results, table)
        back = (spark.table(table).groupBy("Status").agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(name).alias("result_table"), "Status", "rows"))
        out = back if out is None else out.unionByName(back)
    return out


REG_DB = "copyaudit_reg"
REG_TABLE = f"{REG_DB}.orders_parts"
MISSING_TABLE = f"{REG_DB}.missing_table"
HIST_TABLE = f"{REG_DB}.orders_hist"


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One statement batch per orders month, in the shape the jobs receive."""
    months = recipes.source_partitions(spark, sf_dir, [recipes.ORDERS]).select(
        F.col("partition_date").alias("batch_id"))
    m = F.substring("batch_id", 6, 2)
    first = F.concat(F.lit(f"ALTER TABLE {REG_TABLE} ADD PARTITION (ods='"), F.col("batch_id"), F.lit("')"))
    second = (F.when(m == "11", first)
              .when(m == "02", F.concat(F.lit(f"ALTER TABLE {REG_TABLE} ADD PARTITION (bad_col='"),
                                        F.col("batch_id"), F.lit("')")))
              .when(m == "07", F.concat(F.lit(f"ALTER TABLE {MISSING_TABLE} ADD PARTITION (ods='"),
                                        F.col("batch_id"), F.lit("')")))
              .when(m == "12", F.concat(F.lit(f"ALTER TABLE {HIST_TABLE} ADD IF NOT EXISTS PARTITION (ods='"),
                                        F.col("batch_id"), F.lit("', src='x')")))
              .when(m == "03", F.concat(F.lit(f"alter  table {HIST_TABLE} add partition (src='y', ods='"),
                                        F.col("batch_id"), F.lit("') partition (src='z', ods='"),
                                        F.col("batch_id"), F.lit("')")))
              .when(m == "05", F.concat(F.lit(f"ALTER TABLE {HIST_TABLE} ADD PARTITION (src='x, ALTER y;[1]', ods=\""),
                                        F.col("batch_id"), F.lit("\")")))
              .when(m == "04", F.concat(F.lit(f"ALTER TABLE {REG_TABLE} ADD PARTITION (ods=\""), F.col("batch_id"),
                                        F.lit("\") LOCATION 'extra/"), F.col("batch_id"), F.lit("'"))))
    body = F.when(second.isNull(), first).otherwise(F.concat(first, F.lit(",\n"), second))
    return months.select("batch_id", F.concat(F.lit("["), body, F.lit(";]")).alias("batch"))


# Quoted values, text between them, or a quote that is not closed.
TOKEN_SQL = r'''''[^''\\]*(?:\\.[^''\\]*)*''|"[^"\\]*(?:\\.[^"\\]*)*"|[^''"]+|[''"]'''

BATCH_SQL = f"""
months AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS batch_id FROM orders),
stm AS (
  SELECT batch_id,
         'ALTER TABLE {REG_TABLE} ADD PARTITION (ods=''' || batch_id || ''')' AS first,
         CASE substr(batch_id, 6, 2)
           WHEN '11' THEN 'ALTER TABLE {REG_TABLE} ADD PARTITION (ods=''' || batch_id || ''')'
           WHEN '02' THEN 'ALTER TABLE {REG_TABLE} ADD PARTITION (bad_col=''' || batch_id || ''')'
           WHEN '07' THEN 'ALTER TABLE {MISSING_TABLE} ADD PARTITION (ods=''' || batch_id || ''')'
           WHEN '12' THEN 'ALTER TABLE {HIST_TABLE} ADD IF NOT EXISTS PARTITION (ods=''' || batch_id
                          || ''', src=''x'')'
           WHEN '03' THEN 'alter  table {HIST_TABLE} add partition (src=''y'', ods=''' || batch_id
                          || ''') partition (src=''z'', ods=''' || batch_id || ''')'
           WHEN '05' THEN 'ALTER TABLE {HIST_TABLE} ADD PARTITION (src=''x, ALTER y;[1]'', ods="' || batch_id || '")'
           WHEN '04' THEN 'ALTER TABLE {REG_TABLE} ADD PARTITION (ods="' || batch_id || '") LOCATION ''extra/'
                          || batch_id || ''''
         END AS second
  FROM months),
batches AS (
  SELECT batch_id,
         '[' || CASE WHEN second IS NULL THEN first ELSE first || ',' || chr(10) || second END || ';]' AS batch
  FROM stm),
pieces AS (
  SELECT batch_id, string_split(array_to_string(list_transform(
           regexp_extract_all(batch, '(?s){TOKEN_SQL}'),
           lambda t: CASE WHEN len(t) > 1 AND regexp_matches(t, '^[''"]') THEN t
                          ELSE regexp_replace(t, '(?i),\\s*(ALTER\\s)', chr(1) || '\\1', 'g') END), ''), chr(1)) AS parts
  FROM batches),
stmts AS (
  SELECT batch_id, ordinal, trim(regexp_replace(array_to_string(list_transform(
           regexp_extract_all(part, '(?s){TOKEN_SQL}'),
           lambda t: CASE WHEN len(t) > 1 AND regexp_matches(t, '^[''"]') THEN t
                          ELSE regexp_replace(t, '[\\[\\]\\n;]', '', 'g') END), ''), ',\\s*$', '')) AS statement
  FROM (SELECT batch_id, CAST(unnest(generate_series(0, len(parts) - 1)) AS INTEGER) AS ordinal, unnest(parts) AS part
        FROM pieces)),
named AS (
  SELECT *, CASE WHEN len(regexp_split_to_array(statement, '\\s+')) >= 3 THEN regexp_split_to_array(statement, '\\s+')[3]
                 ELSE 'unknown' END AS statement_table
  FROM stmts WHERE statement <> '')"""


@query("q20_statement_normalise", "WITH" + BATCH_SQL + """
SELECT batch_id, ordinal, statement FROM named""")
def q20_statement_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches split at statement starts (not inside a spec), cleaned."""
    from copyaudit.plans.registration import split_statements
    return split_statements(_batches(spark, sf_dir)).select("batch_id", "ordinal", "statement")


@query("q21_statement_table", "WITH" + BATCH_SQL + """
SELECT batch_id, ordinal, statement_table FROM named""")
def q21_statement_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table each statement targets (third token)."""
    from copyaudit.plans.registration import split_statements
    return split_statements(_batches(spark, sf_dir)).select("batch_id", "ordinal", "statement_table")


@query("q22_register_partitions", "WITH" + BATCH_SQL + f""",
outcomes AS (
  SELECT batch_id, ordinal, statement_table,
         CASE WHEN ordinal = 0 THEN 'ok'
              WHEN substr(batch_id, 6, 2) IN ('03', '05', '12') THEN 'ok'
              ELSE 'failed' END AS outcome
  FROM named)
SELECT batch_id, ordinal, statement_table, outcome,
       CASE WHEN outcome <> 'ok' THEN 'Partition update failed for {O.SRC_SYSTEM} {O.COUNTRY} '
            || statement_table || ' due to:' END AS message,
       CASE WHEN outcome <> 'ok' THEN 'MetaUpdate_{O.SRC_SYSTEM}_{O.COUNTRY}_' || statement_table || '_'
            || batch_id || '_failure.csv' END AS failure_file
FROM outcomes""")
def q22_register_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the batches to a catalog table; one outcome per statement."""
    from copyaudit.plans.registration import apply_statements, registration_failures, split_statements
    from copyaudit.session import scratch_path
    base = scratch_path(spark, "q22")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {REG_DB} LOCATION '{base}/db'")
    for table, cols, keys in ((REG_TABLE, "o_orderkey BIGINT, ods STRING", "ods"),
                              (HIST_TABLE, "o_orderkey BIGINT, ods STRING, src STRING", "ods, src")):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({cols}) USING orc PARTITIONED BY ({keys}) "
                  f"LOCATION '{base}/{table.split(chr(46))[1]}'")
    outcomes = apply_statements(spark, split_statements(_batches(spark, sf_dir)))
    fails = registration_failures(outcomes, O.SRC_SYSTEM, O.COUNTRY, O.STATUS_DIR).select(
        "partition_date", "ordinal", "message", "failure_file")
    return (outcomes.join(fails, (outcomes.batch_id == fails.partition_date) & (outcomes.ordinal == fails.ordinal),
                          "left")
            .select(outcomes.batch_id, outcomes.ordinal, "statement_table", "outcome", "message", "failure_file"))
