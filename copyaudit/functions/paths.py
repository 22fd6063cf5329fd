"""Path and name expressions.

Two-way layout: ``<parent>/<db>/<table>/<col>=<value>`` in the source store and
the same path below a store prefix in the target store. Three-way layout: the
source copy below a container, a staging root per database, and the
destination below the parent directory.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from copyaudit.schemas import MATCH, NONMATCH, PLAIN_STAGING

ColumnOrStr = Column | str


def _c(x: ColumnOrStr) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_one_slash(prefix: ColumnOrStr) -> Column:
    """Drop exactly one trailing ``/`` (``a//`` keeps one)."""
    return F.regexp_replace(_c(prefix), "/$", "")


def path_part(uri: ColumnOrStr) -> Column:
    """The path of a URI without ``scheme://authority``; plain paths unchanged."""
    return F.regexp_replace(_c(uri), "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def partition_dir(partition_col: ColumnOrStr, value: ColumnOrStr) -> Column:
    return F.concat(_c(partition_col), F.lit("="), _c(value))


def table_root(parent: ColumnOrStr, db: ColumnOrStr, table: ColumnOrStr) -> Column:
    return F.concat_ws("/", _c(parent), _c(db), _c(table))


def source_partition_path(parent, db, table, partition_col, value) -> Column:
    """``parent/db/table/col=value``."""
    return F.concat_ws("/", table_root(parent, db, table), partition_dir(partition_col, value))


def target_partition_path(prefix, source_path) -> Column:
    """Target store prefix (one trailing slash removed) + source path.

    Only the path component of the source is appended, so a parent given as a
    full URI does not produce two schemes in one path.
    """
    return F.concat(strip_one_slash(prefix), path_part(source_path))


def container_source_root(container, parent, db, table) -> Column:
    """The container copy of a table, ``container + parent/db/table``."""
    return F.concat(_c(container), table_root(parent, db, table))


def staging_partition_path(staging_root, table, partition_col, value) -> Column:
    """P5: ``staging_root/table/col=value``; plain tables have no staging copy."""
    return (F.when(_c(staging_root) == F.lit(PLAIN_STAGING), F.lit(PLAIN_STAGING))
            .otherwise(F.concat_ws("/", _c(staging_root), _c(table),
                                   partition_dir(partition_col, value))))


def control_name(db, table, partition, is_match: Column) -> Column:
    """``db_table_partition.match`` or ``.nonmatch``."""
    return F.concat(_c(db), F.lit("_"), _c(table), F.lit("_"), _c(partition), F.lit("."),
                    F.when(is_match, F.lit(MATCH)).otherwise(F.lit(NONMATCH)))


def two_way_control_dir(prefix, system, country, db) -> Column:
    """P16 (two-way): ``prefix/system/country/db``."""
    return F.concat_ws("/", strip_one_slash(prefix), _c(system), _c(country), _c(db))


def three_way_control_dir(ctrl_path) -> Column:
    """P16 (three-way): ``ctrl/global``."""
    return F.concat(_c(ctrl_path), F.lit("/global"))


def registration_failure_path(status_dir, system, country, table, partition) -> Column:
    """P20: ``dir/MetaUpdate_<sys>_<country>_<tbl>_<part>_failure.csv``."""
    return F.concat(_c(status_dir), F.lit("/MetaUpdate_"), _c(system), F.lit("_"), _c(country),
                    F.lit("_"), _c(table), F.lit("_"), _c(partition), F.lit("_failure.csv"))


def file_name(path: ColumnOrStr) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def parent_dir(path: ColumnOrStr) -> Column:
    return F.regexp_extract(_c(path), "^(.*)/[^/]*$", 1)
