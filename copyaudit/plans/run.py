"""Run an audit end to end: verdicts once, then every sink.

Order matters for failure semantics: results are appended first, control
records second (a consumer that sees a control record can rely on the result
row being there), failure rows third. The verdict frame is checkpointed to the
shared checkpoint folder first, so the sinks never re-read the copies and a
lost executor after that point costs only the tiny verdict frame.

The manifest comes last: a run that is killed before does not count, and the
next run of the same audit takes its rows away (``sinks.journal``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from copyaudit.operators.results import SUMMARY, exit_code, summary_counts
from copyaudit.plans.audits import Audit
from copyaudit.session import checkpoint_root
from copyaudit.sinks.files import new_run_id, write_controls, write_failures, write_marker_files
from copyaudit.sinks.journal import Journal, named_files, table_location
from copyaudit.sinks.tables import append_results


def run_name(audit: Audit, result_table: str, control_path: str) -> str:
    """The same for every run that audits the same items into the same places."""
    items = audit.verdicts.agg(F.count(F.lit(1)), F.sum(F.xxhash64("db", "table", "partition_date").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((audit.kind, result_table, control_path, *items)).encode()).hexdigest()[:16]


def run_audit(audit: Audit, result_table: str, control_path: str, failure_path: str,
              markers: bool = False, journal: str | None = None) -> DataFrame:
    """Write results, controls and failures, commit the run; return the one-row run summary.

    ``markers=True`` also creates the empty ``<name>.match|nonmatch`` files in
    each control directory, for consumers that wait for them by name.
    ``journal``: the folder of the runs' intents and manifests (default: ``_runs`` beside the control records). The
    summary is observed while the verdicts are stored and needs no job of its own.
    """
    spark = audit.verdicts.sparkSession
    checkpoint_root(spark)
    counts = Observation("run summary")
    done = Audit(audit.kind, audit.work, audit.stats_rows,
                 audit.verdicts.observe(counts, *summary_counts()).checkpoint(eager=True))
    run, log = new_run_id(), Journal(spark, journal or f"{control_path}/_runs")
    name = run_name(done, result_table, control_path)
    places = {"result_table": result_table, "result_location": table_location(spark, result_table),
              "folders": [control_path, failure_path]}
    log.begin(run, name, places)
    with named_files(spark, run):
        append_results(done.results, result_table)
    write_controls(done.controls, control_path, audited=done.verdicts, run=run)
    if markers:
        write_marker_files(spark, done.controls)
    problems = Observation("argument problems")
    failures = done.failures.observe(problems, F.count_if(F.col("stage") == "Parameters").alias("problems"))
    write_failures(failures, failure_path, audited=done.verdicts, run=run)
    log.commit(run, name, places)
    found = counts.get
    found["errors"] += problems.get["problems"]
    return spark.createDataFrame([tuple(found[f] for f in SUMMARY)], ", ".join(f"{f} long" for f in SUMMARY)) \
        .withColumn("exit_code", exit_code())


def run_two_way(spark, params, partitions, result_table: str, control_path: str, failure_path: str,
                markers: bool = False) -> DataFrame:
    """Two-way audit over paths with read-time errors isolated, all sinks written."""
    from copyaudit.plans.audits import audit_two_way
    return run_audit(audit_two_way(spark, params, partitions), result_table, control_path,
                     failure_path, markers)


def run_three_way(spark, params, partitions, result_table: str, control_path: str,
                  failure_path: str, markers: bool = False) -> DataFrame:
    """Three-way audit over paths with read-time errors isolated, all sinks written."""
    from copyaudit.plans.audits import audit_three_way
    return run_audit(audit_three_way(spark, params, partitions), result_table, control_path,
                     failure_path, markers)
