"""Failure message texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Failure message formats and the stage labels they carry.
TWO_WAY_FORMAT = "db: %s, table: %s, cause: %s"
THREE_WAY_FORMAT = "%s failed for table %s.%s due to %s"
REGISTRATION_FORMAT = "Partition update failed for %s %s %s due to:"
MISSING_COLUMN_MAP_FORMAT = "failed to get Column Map for db %s"
STAGE_FILE_COUNT = "FileCount"
STAGE_COMPUTE = "ComputeStats"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def two_way_failure(db, table, cause) -> Column:
    """``db: <db>, table: <table>, cause: <cause>``."""
    return F.format_string(TWO_WAY_FORMAT, _c(db), _c(table), _c(cause))


def three_way_failure(stage, db, table, cause) -> Column:
    """``<stage> failed for table <db>.<table> due to <cause>``."""
    return F.format_string(THREE_WAY_FORMAT, _c(stage), _c(db), _c(table), _c(cause))


def registration_failure(system, country, table) -> Column:
    """``Partition update failed for <sys> <country> <tbl> due to:``."""
    return F.format_string(REGISTRATION_FORMAT, _c(system), _c(country), _c(table))


def missing_column_map(db) -> Column:
    """``failed to get Column Map for db <db>``."""
    return F.format_string(MISSING_COLUMN_MAP_FORMAT, _c(db))
