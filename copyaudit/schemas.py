"""Fixed output contracts.

Result tables are inserted *by position*, so the order of the fields below is
part of the contract. Counters are BIGINT in the tables; they stay ``LongType``
end to end (a string counter cannot be inserted into a BIGINT column).
"""

from __future__ import annotations

from pyspark.sql.types import (IntegerType, LongType, StringType, StructField,
                               StructType)

# Verdict strings, roles, control suffixes, plain staging marker.
STATUS_DONE = "Done"
STATUS_FAILED = "Failed"
ROLE_SOURCE = "source"
ROLE_STAGING = "staging"
ROLE_TARGET = "target"
MATCH = "match"
NONMATCH = "nonmatch"
PLAIN_STAGING = "Plain"
NO_PARTITION_COLUMN = "None"
SENTINEL = -1

TWO_WAY_COUNTERS = [
    "SourcePartRecordCount", "TargetPartRecordCount",
    "SourcePartFileCount", "TargetPartFileCount",
    "SourcePartSize", "TargetPartSize",
]

THREE_WAY_COUNTERS = [
    "SourcePartRecordCount", "StagingPartRecordCount", "TargetPartRecordCount",
    "SourcePartFileCount", "StagingPartFileCount", "TargetPartFileCount",
    "SourcePartSize", "StagingPartSize", "TargetPartSize",
]


def _fields(strings_before, longs, strings_after):
    return ([StructField(n, StringType()) for n in strings_before]
            + [StructField(n, LongType()) for n in longs]
            + [StructField(n, StringType()) for n in strings_after])


TWO_WAY_RESULT = StructType(_fields(
    ["SrcSystem", "Country", "SchemaName", "TableName"],
    TWO_WAY_COUNTERS,
    ["SourcePath", "TargetPath", "Status", "partition_date"]))

THREE_WAY_RESULT = StructType(_fields(
    ["SrcSystem", "Country", "SchemaName", "TableName"],
    THREE_WAY_COUNTERS,
    ["SourcePath", "StagingPath", "TargetPath", "Status", "partition_date"]))

# one row per physical or logical copy partition, at any granularity
COPY_STATS = StructType([
    StructField("db", StringType()),
    StructField("table", StringType()),
    StructField("role", StringType()),
    StructField("partition_date", StringType()),
    StructField("records", LongType()),
    StructField("files", LongType()),
    StructField("bytes", LongType()),
])

CONTROL = StructType([
    StructField("control_dir", StringType()),
    StructField("control_name", StringType()),
    StructField("outcome", StringType()),
    StructField("partition_date", StringType()),
])

FAILURE = StructType([
    StructField("stage", StringType()),
    StructField("db", StringType()),
    StructField("table", StringType()),
    StructField("partition_date", StringType()),
    StructField("message", StringType()),
    StructField("exception", StringType()),
    StructField("ordinal", IntegerType()),
])

TWO_WAY_DDL_COLUMNS = ", ".join(
    f"{f.name} {'BIGINT' if isinstance(f.dataType, LongType) else 'STRING'}"
    for f in TWO_WAY_RESULT.fields)
THREE_WAY_DDL_COLUMNS = ", ".join(
    f"{f.name} {'BIGINT' if isinstance(f.dataType, LongType) else 'STRING'}"
    for f in THREE_WAY_RESULT.fields)
