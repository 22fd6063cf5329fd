"""Copies derived from the driver's tables, for the registered queries.

Each audited table has a source copy (all rows), optionally a staging copy and
a target copy, each defined by a per-row *weight*: 0 = row absent from the
copy, 1 = present, 2 = present twice (a duplicated row). Weights let one scan
of a table yield the counts of all its copies in a single ``groupBy``; the
same weights also materialise a copy's rows (``explode(sequence(1, w))``)
when a physical copy is written.

A copy partition whose weights sum to zero does not exist (that is how a
target partition goes missing).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.schemas import ROLE_SOURCE, ROLE_STAGING, ROLE_TARGET


@dataclass(frozen=True)
class Recipe:
    name: str                    # driver table
    db: str
    table_type: str              # 't' tokenized, 'p' plain
    partition_col: str
    fmt: str
    partition: Callable[[], Column]
    weights: dict = field(default_factory=dict)   # role -> () -> Column

    def roles(self) -> list[str]:
        return list(self.weights)


# The derived copies (table, db, type, partition column, format,
# and which rows each copy keeps, drops or duplicates).
def _orders_target() -> Column:
    month = F.month("o_orderdate")
    return (F.when(F.date_format("o_orderdate", "yyyy-MM") == "1998-03", 0)
            .when(month.isin(2, 7) & (F.col("o_orderkey") % 5 == 0), 0)
            .when((month == 11) & (F.col("o_orderkey") % 50 == 0), 2)
            .otherwise(1))


def _lineitem_staging() -> Column:
    return F.when((F.year("l_shipdate") == 1997) & (F.col("l_linenumber") == 7), 0).otherwise(1)


def _lineitem_target() -> Column:
    return (F.when(_lineitem_staging() == 0, 0)
            .when((F.month("l_shipdate") == 6) & (F.col("l_orderkey") % 5 == 0), 0)
            .otherwise(1))


def _events_target() -> Column:
    return F.when((F.dayofmonth("ts") % 10 == 0) & (F.col("event_id") % 3 == 0), 0).otherwise(1)


ORDERS = Recipe("orders", "sri_open", "p", "ods", "orc",
                lambda: F.date_format("o_orderdate", "yyyy-MM"),
                {ROLE_SOURCE: lambda: F.lit(1), ROLE_TARGET: _orders_target})
LINEITEM = Recipe("lineitem", "sri_non_open", "t", "nds", "orc",
                  lambda: F.date_format("l_shipdate", "yyyy-MM"),
                  {ROLE_SOURCE: lambda: F.lit(1), ROLE_STAGING: _lineitem_staging,
                   ROLE_TARGET: _lineitem_target})
EVENTS = Recipe("events", "storage", "p", "vds", "avro",
                lambda: F.date_format("ts", "yyyy-MM-dd"),
                {ROLE_SOURCE: lambda: F.lit(1), ROLE_TARGET: _events_target})

RECIPES = {r.name: r for r in (ORDERS, LINEITEM, EVENTS)}

# Work items whose source partition does not exist.
ABSENT_ITEMS = [("sri_open", "orders", "2002-01"), ("storage", "events", "2025-01-01")]

# File facts of a derived (unwritten) copy partition.
RECORDS_PER_FILE = 64
BYTES_PER_RECORD = 100
EXTRA_STAGING_FILE_MONTH = "09"


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def copy_rows(spark: SparkSession, sf_dir: str, recipe: Recipe, role: str) -> DataFrame:
    """Rows of one copy, with the partition column, ready to be written."""
    base = base_table(spark, sf_dir, recipe.name)
    w = recipe.weights[role]()
    return (base.withColumn(recipe.partition_col, recipe.partition())
            .withColumn("_w", w)
            .where(F.col("_w") > 0)
            .withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_w"))))
            .drop("_w", "_n"))


def rows_of_copies(spark: SparkSession, sf_dir: str, recipe: Recipe, roles: list[str], role_col: str = "copy_role") -> DataFrame:
    """Rows of several copies, each with its role, every partition in one task: one shuffle of the table serves all copies."""
    base = (base_table(spark, sf_dir, recipe.name).withColumn(recipe.partition_col, recipe.partition())
            .repartition(recipe.partition_col))
    times = [F.array_repeat(F.lit(r), F.coalesce(recipe.weights[r](), F.lit(0))) for r in roles]
    return base.withColumn(role_col, F.explode(F.flatten(F.array(*times))))


def recipe_counts(spark: SparkSession, sf_dir: str, recipe: Recipe) -> DataFrame:
    """Records per (role, partition) of every copy of one table, one scan."""
    base = base_table(spark, sf_dir, recipe.name)
    roles = recipe.roles()
    weighted = base.select(recipe.partition().alias("partition_date"),
                           *[recipe.weights[r]().alias(r) for r in roles])
    per_part = weighted.groupBy("partition_date").agg(*[F.sum(r).cast("long").alias(r) for r in roles])
    return (per_part.unpivot(["partition_date"], roles, "role", "records")
            .where(F.col("records") > 0)
            .select(F.lit(recipe.db).alias("db"), F.lit(recipe.name).alias("table"),
                    "role", "partition_date", "records"))


def with_file_facts(counts: DataFrame) -> DataFrame:
    """Files and bytes of an unwritten copy, from its record count."""
    extra = F.when((F.col("role") == ROLE_STAGING)
                   & (F.substring("partition_date", 6, 2) == EXTRA_STAGING_FILE_MONTH), 1).otherwise(0)
    return counts.select(
        "db", "table", "role", "partition_date", "records",
        (F.ceil(F.col("records") / F.lit(RECORDS_PER_FILE)) + extra).cast("long").alias("files"),
        (F.col("records") * F.lit(BYTES_PER_RECORD)).cast("long").alias("bytes"))


def recipe_stats(spark: SparkSession, sf_dir: str, recipes: list[Recipe]) -> DataFrame:
    """COPY_STATS rows of all copies of the given tables (one scan per table)."""
    from copyaudit.sources.copies import union_all
    return union_all([with_file_facts(recipe_counts(spark, sf_dir, r)) for r in recipes])


def work_partitions(spark: SparkSession, stats: DataFrame, recipes: list[Recipe]) -> DataFrame:
    """Every source partition, plus the absent items of these tables."""
    names = {r.name for r in recipes}
    absent = [a for a in ABSENT_ITEMS if a[1] in names]
    present = stats.where(F.col("role") == ROLE_SOURCE).select("db", "table", "partition_date")
    if not absent:
        return present
    return present.unionByName(spark.createDataFrame(absent, "db string, table string, partition_date string"))


def source_partitions(spark: SparkSession, sf_dir: str, tables: list[Recipe] | None = None) -> DataFrame:
    """Distinct source partition values per table name: ``table``, ``partition_date``."""
    frames = [base_table(spark, sf_dir, r.name)
              .select(F.lit(r.name).alias("table"), r.partition().alias("partition_date")).distinct()
              for r in (tables or list(RECIPES.values()))]
    from copyaudit.sources.copies import union_all
    return union_all(frames)


def work_items(spark: SparkSession, sf_dir: str, tables: list[Recipe], by_db: bool = True) -> DataFrame:
    """Source partitions of the tables plus their absent items.

    ``by_db``: keyed by (db, table); otherwise by table name only, so every
    database paired with the table gets the same partitions.
    """
    names = {r.name for r in tables}
    present = source_partitions(spark, sf_dir, tables)
    absent = spark.createDataFrame([a for a in ABSENT_ITEMS if a[1] in names],
                                   "db string, table string, partition_date string")
    if by_db:
        dbs = spark.createDataFrame([(r.name, r.db) for r in tables], "table string, db string")
        present = present.join(dbs, "table")
        return present.select("db", "table", "partition_date").unionByName(absent)
    return present.unionByName(absent.select("table", "partition_date"))
