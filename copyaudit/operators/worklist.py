"""Work lists: which (db, table, partition) items to audit, and where they live.

The original jobs loop over ``table x database`` on the driver and audit one
partition per turn. Here the whole work list is one DataFrame:

* the ``db x table`` pairs come from two argument lists through two chained
  generators (no join); their number is bounded by the arguments;
* the partitions per pair come from an argument list (exploded) or from a
  DataFrame of ``(table[, db], partition_date)`` joined on its keys, so a
  backfill over many dates is the same plan as a nightly run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.functions import messages, paths, routing
from copyaudit.schemas import NO_PARTITION_COLUMN, PLAIN_STAGING, ROLE_SOURCE, ROLE_STAGING, ROLE_TARGET
from copyaudit.sources.arguments import lookup_join_side, partition_map_frame
from copyaudit.sources.copies import CopyLocation


@dataclass
class TwoWayParams:
    src_system: str
    country: str
    source_parent: str
    target_prefix: str
    tables: str
    databases: str
    partition_map: str
    data_format: str = "orc"


@dataclass
class ThreeWayParams:
    src_system: str
    country: str
    container: str
    parent_dir: str
    open_staging_dir: str
    non_open_staging_dir: str
    storage_staging_dir: str
    databases: str
    tables: str
    ctrl_path: str
    partition_map: str | None = None
    use_partition_map: bool = False
    plain_rule: str = "source_target"


@dataclass
class WorkList:
    tables: DataFrame      # one row per (db, table): roots, routing
    items: DataFrame       # one row per (db, table, partition_date): paths
    problems: DataFrame    # argument problems: stage, message


def table_db_pairs(spark: SparkSession, databases: str, tables: str, db_outer: bool = False) -> DataFrame:
    """Every table with every database, as two chained ``posexplode``s."""
    outer_name, outer_text, inner_name, inner_text = (
        ("db", databases, "table_spec", tables) if db_outer else ("table_spec", tables, "db", databases))
    return (spark.range(1).select()
            .select(F.posexplode(F.split(F.lit(outer_text), ",")).alias(f"{outer_name}_pos", outer_name))
            .where(F.col(outer_name) != "")
            .select("*", F.posexplode(F.split(F.lit(inner_text), ",")).alias(f"{inner_name}_pos", inner_name))
            .where(F.col(inner_name) != ""))


def attach_partitions(work: DataFrame, partitions, how: str = "inner") -> DataFrame:
    """One item per requested partition of each pair.

    ``partitions`` is a value, a list of values (applies to every pair), or a
    DataFrame with ``partition_date`` and ``table`` (optionally ``db``).
    """
    if isinstance(partitions, str):
        partitions = [partitions]
    if isinstance(partitions, (list, tuple)):
        values = F.array(*[F.lit(v) for v in partitions])
        return work.withColumn("partition_date", F.explode(values))
    keys = [k for k in ("db", "table") if k in partitions.columns]
    return work.join(partitions.select(*keys, "partition_date"), on=keys, how=how)


def _map_problems(bad_pairs: DataFrame) -> DataFrame:
    return bad_pairs.select(
        F.lit("Parameters").alias("stage"),
        F.format_string("malformed db:column pair '%s'", F.col("pair")).alias("message"))


def two_way_work_list(spark: SparkSession, p: TwoWayParams, partitions,
                      partition_join: str = "inner") -> WorkList:
    """Items of the two-way audit."""
    pairs = table_db_pairs(spark, p.databases, p.tables).withColumnRenamed("table_spec", "table")
    lookup, bad_pairs = partition_map_frame(spark, p.partition_map)
    # Looked up by lower(db); keys were lowered too
    tables = (pairs.join(lookup_join_side(lookup, p.partition_map),
                         F.lower(F.col("db")) == F.col("db_key"), "left")
              .select(
                  F.lit(p.src_system).alias("SrcSystem"), F.lit(p.country).alias("Country"),
                  "db", "table", "partition_col",
                  F.lit(p.data_format).alias("data_format"),
                  paths.table_root(F.lit(p.source_parent), "db", "table").alias("source_root"),
                  F.concat(paths.strip_one_slash(F.lit(p.target_prefix)),
                           paths.path_part(paths.table_root(F.lit(p.source_parent), "db", "table"))
                           ).alias("target_root"),
                  paths.two_way_control_dir(F.lit(p.target_prefix), F.lit(p.src_system), F.lit(p.country),
                                            "db").alias("control_dir"),
                  F.when(F.col("partition_col").isNull(), messages.missing_column_map("db")).alias("problem")))
    found = F.col("partition_col").isNotNull()
    source_path = paths.source_partition_path(F.lit(p.source_parent), "db", "table", "partition_col",
                                              "partition_date")
    items = attach_partitions(tables, partitions, partition_join).select(
        "*", F.when(found, source_path).alias("source_path"),
        F.when(found, paths.target_partition_path(F.lit(p.target_prefix), source_path)).alias("target_path"))
    return WorkList(tables=tables, items=items, problems=_map_problems(bad_pairs))


def three_way_work_list(spark: SparkSession, p: ThreeWayParams, partitions,
                        partition_join: str = "inner") -> WorkList:
    """Items of the three-way audit (database outer)."""
    pairs = table_db_pairs(spark, p.databases, p.tables.replace('"', ""), db_outer=True)
    spec = F.col("table_spec")
    tables = pairs.select(
        "db", "table_spec",
        routing.table_name(spec).alias("table"),
        routing.table_type(spec).alias("table_type"))
    if p.use_partition_map and p.partition_map:
        lookup, bad_pairs = partition_map_frame(spark, p.partition_map)
        tables = (tables.join(lookup_join_side(lookup, p.partition_map),
                              F.lower(F.col("db")) == F.col("db_key"), "left")
                  .withColumn("partition_col", F.coalesce("partition_col", F.lit(NO_PARTITION_COLUMN)))
                  .drop("db_key"))
    else:
        bad_pairs = None
        tables = tables.withColumn("partition_col", routing.partition_column_case("db"))
    staging = routing.staging_root("table_type", "db", F.lit(p.open_staging_dir),
                                   F.lit(p.non_open_staging_dir), F.lit(p.storage_staging_dir))
    tables = tables.select(
        F.lit(p.src_system).alias("SrcSystem"), F.lit(p.country).alias("Country"),
        "db", "table_spec", "table", "table_type", "partition_col",
        routing.data_format("db").alias("data_format"),
        staging.alias("staging_dir"),
        paths.container_source_root(F.lit(p.container), F.lit(p.parent_dir), "db", "table").alias("source_root"),
        F.when(staging == F.lit(PLAIN_STAGING), F.lit(PLAIN_STAGING))
         .otherwise(F.concat_ws("/", staging, F.col("table"))).alias("staging_root"),
        paths.table_root(F.lit(p.parent_dir), "db", "table").alias("target_root"),
        paths.three_way_control_dir(F.lit(p.ctrl_path)).alias("control_dir"),
        routing.valid_table_type("table_type").alias("valid_type"))
    part = paths.partition_dir("partition_col", "partition_date")
    items = attach_partitions(tables, partitions, partition_join).select(
        "*", F.concat_ws("/", "source_root", part).alias("source_path"),
        paths.staging_partition_path("staging_dir", "table", "partition_col", "partition_date").alias("staging_path"),
        F.concat_ws("/", "target_root", part).alias("target_path"))
    problems = (spark.createDataFrame([], "stage string, message string") if bad_pairs is None
                else _map_problems(bad_pairs))
    return WorkList(tables=tables, items=items, problems=problems)


def copy_locations(tables: DataFrame, roles: list[str]) -> list[CopyLocation]:
    """Distinct physical copies to scan, one per (db, table, role).

    ``tables`` is a work list's ``tables`` (every argument pair) or ``items``
    (only pairs with partitions to audit); either way the distinct roots are
    bounded by the argument pairs, not by the data, so this collect is small.
    """
    root_col = {ROLE_SOURCE: "source_root", ROLE_STAGING: "staging_root", ROLE_TARGET: "target_root"}
    cols = ["db", "table", "partition_col", "data_format"] + [root_col[r] for r in roles]
    if "table_type" in tables.columns:
        cols.append("table_type")
    rows = tables.where(F.col("partition_col").isNotNull()).select(*cols).distinct().collect()
    out: dict[tuple, CopyLocation] = {}
    for row in rows:
        for role in roles:
            root = row[root_col[role]]
            if role == ROLE_STAGING and (root == PLAIN_STAGING or row["table_type"] != "t"):
                continue
            loc = CopyLocation(row["db"], row["table"], role, root, row["partition_col"], row["data_format"])
            out[(loc.db, loc.table, loc.role, loc.root)] = loc
    return list(out.values())
