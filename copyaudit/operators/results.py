"""Result rows, control records, failure rows and the run summary.

P12/P13 are single projections of the verdict frame in the DDL column order
(the tables are written by position). Control records (P15, P16, F6) and
failure rows (P19, U1) are projections of the same frame, so one cached or
checkpointed verdict frame feeds every sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from copyaudit.functions import messages, paths
from copyaudit.operators.verdict import COMPARED, RESULT_STATES, SOURCE_MISSING
from copyaudit.schemas import STATUS_DONE, THREE_WAY_RESULT, TWO_WAY_RESULT


def _in_results():
    return F.col("state").isin(*RESULT_STATES)


def two_way_results(verdicts: DataFrame) -> DataFrame:
    """The 14-column two-way row; a missing source has an empty target path."""
    out = verdicts.where(_in_results()).select(
        "SrcSystem", "Country",
        F.col("db").alias("SchemaName"), F.col("table").alias("TableName"),
        F.col("source_records_out").alias("SourcePartRecordCount"),
        F.col("target_records_out").alias("TargetPartRecordCount"),
        F.col("source_files_out").alias("SourcePartFileCount"),
        F.col("target_files_out").alias("TargetPartFileCount"),
        F.col("source_bytes_out").alias("SourcePartSize"),
        F.col("target_bytes_out").alias("TargetPartSize"),
        F.col("source_path").alias("SourcePath"),
        F.when(F.col("state") == F.lit(SOURCE_MISSING), F.lit("")).otherwise(F.col("target_path")).alias("TargetPath"),
        "Status", "partition_date")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in TWO_WAY_RESULT.fields])


def three_way_results(verdicts: DataFrame) -> DataFrame:
    """The 18-column three-way row in one projection."""
    out = verdicts.where(_in_results()).select(
        "SrcSystem", "Country",
        F.col("db").alias("SchemaName"), F.col("table").alias("TableName"),
        F.col("source_records_out").alias("SourcePartRecordCount"),
        F.col("staging_records_out").alias("StagingPartRecordCount"),
        F.col("target_records_out").alias("TargetPartRecordCount"),
        F.col("source_files_out").alias("SourcePartFileCount"),
        F.col("staging_files_out").alias("StagingPartFileCount"),
        F.col("target_files_out").alias("TargetPartFileCount"),
        F.col("source_bytes_out").alias("SourcePartSize"),
        F.col("staging_bytes_out").alias("StagingPartSize"),
        F.col("target_bytes_out").alias("TargetPartSize"),
        F.col("source_path").alias("SourcePath"),
        F.col("staging_path").alias("StagingPath"),
        F.col("target_path").alias("TargetPath"),
        "Status", "partition_date")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in THREE_WAY_RESULT.fields])


def two_way_controls(verdicts: DataFrame) -> DataFrame:
    """F6 (two-way): every result row, match when the record counts agree."""
    rows = verdicts.where(_in_results())
    is_match = F.col("source_records_out") == F.col("target_records_out")
    return rows.select(
        "db", "table", F.col("control_dir"),
        paths.control_name("db", "table", "partition_date", is_match).alias("control_name"),
        F.when(is_match, F.lit("match")).otherwise(F.lit("nonmatch")).alias("outcome"),
        "partition_date")


def three_way_controls(verdicts: DataFrame) -> DataFrame:
    """F6 (three-way): compared items only; a missing source writes none."""
    rows = verdicts.where(F.col("state") == F.lit(COMPARED))
    is_match = F.col("Status") == F.lit(STATUS_DONE)
    return rows.select(
        "db", "table", F.col("control_dir"),
        paths.control_name("db", "table", "partition_date", is_match).alias("control_name"),
        F.when(is_match, F.lit("match")).otherwise(F.lit("nonmatch")).alias("outcome"),
        "partition_date")


def _failure_frame(df: DataFrame, stage, message, exception) -> DataFrame:
    return df.select(stage.alias("stage"), "db", "table", "partition_date",
                     message.alias("message"), exception.alias("exception"),
                     F.lit(None).cast("int").alias("ordinal"))


def two_way_failures(verdicts: DataFrame, problems: DataFrame | None = None) -> DataFrame:
    """One row per item that could not be checked."""
    st = F.col("state")
    rows = verdicts.where(~_in_results())
    stage = (F.when(st == "lookup_missing", F.lit("PartitionColumn"))
             .when(st == "source_error", F.lit("SourceSize"))
             .otherwise(F.lit("TargetListing")))
    exception = (F.when(st == "lookup_missing", F.col("problem"))
                 .when(st == "source_error", F.col("source_error"))
                 .when(st == "target_error", F.col("target_error"))
                 .otherwise(F.lit("path not found")))
    cause = (F.when(st == "lookup_missing", F.col("problem"))
             .when(st == "source_error",
                   F.format_string("Failed to get the size of source path %s; %s", F.col("source_path"), exception))
             .otherwise(F.format_string("Failed to get information for target path: %s; %s",
                                        F.col("target_path"), exception)))
    out = _failure_frame(rows, stage, messages.two_way_failure("db", "table", cause), exception)
    return out.unionByName(_problem_failures(problems)) if problems is not None else out


def three_way_failures(verdicts: DataFrame, problems: DataFrame | None = None) -> DataFrame:
    """``<stage> failed for table <db>.<table> due to <cause>``."""
    st = F.col("state")
    rows = verdicts.where(~_in_results())
    stage = (F.when(st == "source_error", F.lit(messages.STAGE_FILE_COUNT))
             .otherwise(F.lit(messages.STAGE_COMPUTE)))
    cause = (F.when(st == "source_error", F.col("source_error"))
             .when(st == "invalid_type",
                   F.format_string("table type '%s' is neither t nor p", F.col("table_type")))
             .when(st == "staging_error", F.col("staging_error"))
             .when(st == "staging_missing", F.format_string("staging path not found: %s", F.col("staging_path")))
             .when(st == "target_error", F.col("target_error"))
             .otherwise(F.format_string("target path not found: %s", F.col("target_path"))))
    out = _failure_frame(rows, stage, messages.three_way_failure(stage, "db", "table", cause), cause)
    return out.unionByName(_problem_failures(problems)) if problems is not None else out


def _problem_failures(problems: DataFrame) -> DataFrame:
    return problems.select(
        F.col("stage"), F.lit(None).cast("string").alias("db"), F.lit(None).cast("string").alias("table"),
        F.lit(None).cast("string").alias("partition_date"), F.col("message"),
        F.col("message").alias("exception"), F.lit(None).cast("int").alias("ordinal"))


SUMMARY = ["items", "done", "failed", "source_missing", "errors"]


def summary_counts() -> list:
    """A4: the counts of ``SUMMARY`` over verdict rows (``state``, ``Status``)."""
    st = F.col("state")
    return [F.count_if(st != "parameter_error").alias("items"),
            F.count_if((st == COMPARED) & (F.col("Status") == STATUS_DONE)).alias("done"),
            F.count_if(F.col("Status") == "Failed").alias("failed"),
            F.count_if(st == SOURCE_MISSING).alias("source_missing"),
            F.count_if(~st.isin(*RESULT_STATES)).alias("errors")]


def exit_code():
    return F.when(F.col("errors") > 0, F.lit(1)).otherwise(F.lit(0))


def run_summary(verdicts: DataFrame, problems: DataFrame | None = None) -> DataFrame:
    """A4: outcome counts of the run and the exit code (1 when anything failed)."""
    rows = verdicts.select("state", "Status")
    if problems is not None:
        rows = rows.unionByName(problems.select(F.lit("parameter_error").alias("state"),
                                                F.lit(None).cast("string").alias("Status")))
    return rows.agg(*summary_counts()).withColumn("exit_code", exit_code())
