"""Physical copies of the driver's tables for path-based audits.

The derived copies of ``recipes`` are written as Hive-style partitioned
datasets (ORC, or Avro for the ``storage`` database) under a fresh folder of
the shared checkpoint root, at the locations the audit's own path rules give
for each (db, table, role). The audit then reads them back like any store.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from copyaudit.functions.paths import path_part
from copyaudit.operators.worklist import (ThreeWayParams, TwoWayParams, copy_locations,
                                          three_way_work_list, two_way_work_list)
from copyaudit.plans import recipes
from copyaudit.schemas import ROLE_STAGING
from copyaudit.session import scratch_path
from copyaudit.sources.copies import CopyLocation, partition_dirs, reader_format


@dataclass
class Layout:
    base: str
    two_way: TwoWayParams | None = None
    three_way: ThreeWayParams | None = None


def _path_only(spark: SparkSession, uri: str) -> str:
    return spark.range(1).select(path_part(F.lit(uri)).alias("p")).first()["p"]


def two_way_layout(spark: SparkSession, name: str, params: TwoWayParams) -> Layout:
    base = scratch_path(spark, name)
    return Layout(base, two_way=replace(params, source_parent=f"{base}/sources/warehouse",
                                        target_prefix=f"{base}/copies/"))


def three_way_layout(spark: SparkSession, name: str, params: ThreeWayParams) -> Layout:
    base = scratch_path(spark, name)
    return Layout(base, three_way=replace(
        params, container=f"{base}/copies", parent_dir=_path_only(spark, f"{base}/sources/warehouse"),
        open_staging_dir=f"{base}/staging/open", non_open_staging_dir=f"{base}/staging/non_open",
        storage_staging_dir=f"{base}/staging/storage", ctrl_path=f"{base}/control"))


# Files that a writing task holds open before it sorts the rest of its rows by partition.
OPEN_FILES = 40


def write_copies(spark: SparkSession, sf_dir: str, layout: Layout, partitions,
                 tables: list[recipes.Recipe], only_roles: list[str] | None = None) -> None:
    """Write every copy of the given tables where the audit will look for it.

    All copies of a table are one write: the table is shuffled once by its partition column, so each copy has a file per
    partition, and the copies' folders are then renamed to their roots.
    """
    if layout.two_way is not None:
        work = two_way_work_list(spark, layout.two_way, partitions)
        roles = ["source", "target"]
    else:
        work = three_way_work_list(spark, layout.three_way, partitions)
        roles = ["source", "staging", "target"]
    locations = copy_locations(work.tables, roles)
    for recipe in tables:
        copies = {loc.role: loc for loc in locations if (loc.db, loc.table) == (recipe.db, recipe.name)
                  and loc.role in recipe.weights and (not only_roles or loc.role in only_roles)}
        if not copies:
            continue
        together = f"{layout.base}/together/{recipe.db}/{recipe.name}"
        rows = recipes.rows_of_copies(spark, sf_dir, recipe, list(copies))
        with open_files(spark, OPEN_FILES):
            (rows.write.partitionBy("copy_role", recipe.partition_col)
             .format(reader_format(next(iter(copies.values())).fmt)).save(together))
        for role, loc in copies.items():
            move_folder(spark, f"{together}/copy_role={role}", loc.root)
            if role == ROLE_STAGING:
                add_empty_files(spark, loc, recipes.EXTRA_STAGING_FILE_MONTH)


@contextmanager
def open_files(spark: SparkSession, number: int) -> Iterator[None]:
    """Writes inside hold up to ``number`` files open a task instead of sorting all rows by partition, which spills."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, number)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def move_folder(spark: SparkSession, folder: str, root: str) -> None:
    """Renames ``folder`` to ``root``, in place of what is there; without ``folder``, ``root`` is an empty folder."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at, to = Path(folder), Path(root)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.delete(to, True)
    if not store.exists(at):
        store.mkdirs(to)
        return
    store.mkdirs(to.getParent())
    if not store.rename(at, to):
        raise OSError(f"cannot rename {folder} to {root}")


def add_empty_files(spark: SparkSession, loc: CopyLocation, month: str) -> None:
    """A zero-length data file in each partition of a month: it counts as a file, and holds nothing."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for d in partition_dirs(spark, [loc])[0].where(F.substr("partition_date", F.lit(6), F.lit(2)) == month).toLocalIterator():
        path = Path(f"{d.dir}/part-empty.{loc.fmt}")
        path.getFileSystem(conf).create(path, True).close()


def empty_sources(spark: SparkSession, layout: Layout, partitions, months: dict[str, bool]) -> None:
    """Takes the data out of the source directories of some months; ``True``: their ``_SUCCESS`` stays."""
    work = two_way_work_list(spark, layout.two_way, partitions) if layout.two_way else \
        three_way_work_list(spark, layout.three_way, partitions)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for d in partition_dirs(spark, copy_locations(work.tables, ["source"]))[0].collect():
        month = d.partition_date[5:7]
        if month in months:
            store = Path(d.dir).getFileSystem(conf)
            store.delete(Path(d.dir), True)
            store.mkdirs(Path(d.dir))
            if months[month]:
                store.create(Path(f"{d.dir}/_SUCCESS"), True).close()
