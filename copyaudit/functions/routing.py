"""Per-item routing: partition column, table spec, staging root, file format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from copyaudit.schemas import NO_PARTITION_COLUMN, PLAIN_STAGING

# Database -> partition column of the three-way audit.
DB_PARTITION_COLUMNS = [
    ("sri_open", "ods"),
    ("sri_non_open", "nds"),
    ("storage", "vds"),
]

# Table type codes (tokenized copies have a staging copy).
TYPE_TOKENIZED = "t"
TYPE_PLAIN = "p"

FORMAT_ORC = "orc"
FORMAT_AVRO = "avro"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def partition_column_case(db) -> Column:
    """Fixed CASE on ``lower(db)``; unknown databases give ``None``."""
    low = F.lower(_c(db))
    expr = None
    for name, column in DB_PARTITION_COLUMNS:
        expr = (F.when(low == F.lit(name), F.lit(column)) if expr is None
                else expr.when(low == F.lit(name), F.lit(column)))
    return expr.otherwise(F.lit(NO_PARTITION_COLUMN))


def spec_parts(spec) -> Column:
    return F.split(_c(spec), "[|]")


def table_name(spec) -> Column:
    """Table name is the spec before ``|``."""
    return F.element_at(spec_parts(spec), 1)


def table_type(spec) -> Column:
    """Type code is the last ``|`` part, lower-cased."""
    return F.lower(F.element_at(spec_parts(spec), -1))


def valid_table_type(type_code) -> Column:
    """only tokenized and plain tables can be audited."""
    return _c(type_code).isin(TYPE_TOKENIZED, TYPE_PLAIN)


def staging_root(type_code, db, open_dir, non_open_dir, storage_dir) -> Column:
    """Staging root of a tokenized table by database; plain tables: ``Plain``."""
    low = F.lower(_c(db))
    tokenized = (F.when(low == F.lit("sri_open"), _c(open_dir))
                 .when(low == F.lit("sri_non_open"), _c(non_open_dir))
                 .when(low == F.lit("storage"), _c(storage_dir))
                 .otherwise(F.lit("")))
    return (F.when(_c(type_code) == F.lit(TYPE_TOKENIZED), tokenized)
            .when(_c(type_code) == F.lit(TYPE_PLAIN), F.lit(PLAIN_STAGING))
            .otherwise(F.lit("")))


def data_format(db) -> Column:
    """P10: Avro when the database name contains ``storage``, else ORC."""
    return (F.when(F.lower(_c(db)).contains("storage"), F.lit(FORMAT_AVRO))
            .otherwise(F.lit(FORMAT_ORC)))
