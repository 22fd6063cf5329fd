"""Command line with the original jobs' positional arguments.

    spark-submit copyaudit/__main__.py two-way   <10 arguments>
    spark-submit copyaudit/__main__.py three-way <14 arguments>
    spark-submit copyaudit/__main__.py register  <5 arguments>

two-way:   src_system country source_parent target_prefix tables partition databases
           db_partition_map result_db result_table
three-way: src_system country container parent_dir open_staging_dir non_open_staging_dir
           storage_staging_dir databases tables db_partition_map business_date result_db
           result_table ctrl_path
register:  src_system country statements status_dir partition

Each audit runs as one set-based job: counts of every copy, verdicts, result rows appended to
``result_db.result_table`` (created if absent), control records (a dataset and the empty
``.match``/``.nonmatch`` marker files), failure rows, and the exit code of the run summary.

The command starts its session with the persistent (Hive) catalog, as the original jobs do; set
``spark.sql.catalogImplementation`` in ``spark-submit --conf`` to choose another. Result tables get a LOCATION beside the
control records, so that they also survive without a persistent catalog.
"""

from __future__ import annotations

import hashlib
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from copyaudit.operators.worklist import ThreeWayParams, TwoWayParams
from copyaudit.sources.arguments import TWO_WAY_ARGUMENTS, TWO_WAY_REQUIRED, parameter_problems

# Positional arguments of the three-way and registration jobs.
THREE_WAY_ARGUMENTS = ["src_system", "country", "container", "parent_dir", "open_staging_dir",
                       "non_open_staging_dir", "storage_staging_dir", "databases", "tables",
                       "partition_map", "business_date", "result_db", "result_table", "ctrl_path"]
REGISTER_ARGUMENTS = ["src_system", "country", "statements", "status_dir", "partition"]


def _check(spark: SparkSession, names: list[str], values: list[str], required: list[str]) -> list[str]:
    """the argument count and the required arguments; returns the problems."""
    if len(values) != len(names):
        return [f"expected {len(names)} arguments ({' '.join(names)}), got {len(values)}"]
    params = spark.createDataFrame([tuple(values)], ", ".join(f"`{n}` string" for n in names))
    return [f"{r['parameter']}: {r['problem']}" for r in parameter_problems(params, required).collect()]


def two_way(spark: SparkSession, args: list[str], out_dir: str | None = None) -> int:
    from copyaudit.plans.run import run_two_way
    from copyaudit.sinks.tables import create_result_table
    problems = _check(spark, TWO_WAY_ARGUMENTS, args, TWO_WAY_REQUIRED)
    if problems:
        print("\n".join(problems), file=sys.stderr)
        return 1
    a = dict(zip(TWO_WAY_ARGUMENTS, args))
    params = TwoWayParams(a["src_system"], a["country"], a["source_parent"], a["target_prefix"],
                          a["tables"], a["databases"], a["partition_map"])
    base = out_dir or f"{a['target_prefix'].rstrip('/')}/{a['src_system']}/{a['country']}"
    table = create_result_table(spark, a["result_db"], a["result_table"], three_way=False,
                                location=f"{base}/_results/{a['result_db']}.{a['result_table']}")
    summary = run_two_way(spark, params, [a["partition"]], table, f"{base}/_control_records",
                          f"{base}/_failures", markers=True).first()
    print(summary.asDict())
    return int(summary["exit_code"])


def three_way(spark: SparkSession, args: list[str]) -> int:
    from copyaudit.plans.run import run_three_way
    from copyaudit.sinks.tables import create_result_table
    problems = _check(spark, THREE_WAY_ARGUMENTS, args, ["databases", "tables", "business_date",
                                                          "result_db", "result_table", "ctrl_path"])
    if problems:
        print("\n".join(problems), file=sys.stderr)
        return 1
    a = dict(zip(THREE_WAY_ARGUMENTS, args))
    params = ThreeWayParams(a["src_system"], a["country"], a["container"], a["parent_dir"], a["open_staging_dir"],
                            a["non_open_staging_dir"], a["storage_staging_dir"], a["databases"], a["tables"],
                            a["ctrl_path"], partition_map=a["partition_map"])
    ctrl = a["ctrl_path"].rstrip("/")
    table = create_result_table(spark, a["result_db"], a["result_table"], three_way=True,
                                location=f"{ctrl}/_results/{a['result_db']}.{a['result_table']}")
    summary = run_three_way(spark, params, [a["business_date"]], table, f"{ctrl}/_control_records",
                            f"{ctrl}/_failures", markers=True).first()
    print(summary.asDict())
    return int(summary["exit_code"])


def register(spark: SparkSession, args: list[str]) -> int:
    from copyaudit.plans.registration import OutcomeLog, apply_statements, registration_failures, split_statements
    from copyaudit.sinks.files import write_failures
    problems = _check(spark, REGISTER_ARGUMENTS, args, ["statements", "status_dir"])
    if problems:
        print("\n".join(problems), file=sys.stderr)
        return 1
    a = dict(zip(REGISTER_ARGUMENTS, args))
    batches = spark.createDataFrame([(a["partition"], a["statements"])], "batch_id string, batch string")
    # the log of a batch lasts until its failures are written: a killed batch that is started again goes on where it stopped
    log = f"{a['status_dir'].rstrip('/')}/_registration/{hashlib.sha256(repr(args).encode()).hexdigest()[:16]}"
    outcomes = apply_statements(spark, split_statements(batches), log=log)
    failures = registration_failures(outcomes, a["src_system"], a["country"], a["status_dir"], a["partition"])
    failures = failures.checkpoint(eager=True)
    if failures.count():
        write_failures(failures, a["status_dir"], name_col="failure_file")
    print({r["outcome"]: r["n"] for r in outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).collect()})
    OutcomeLog(spark, log).remove()
    return 0           # as the original job: failures are reported in files, the run succeeds


COMMANDS = {"two-way": two_way, "three-way": three_way, "register": register}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if not argv or argv[0] not in COMMANDS:
        print(__doc__, file=sys.stderr)
        return 1
    if spark is None:
        from copyaudit.session import build_session
        spark = build_session(app_name=f"copyaudit-{argv[0]}", catalog="hive")
    return COMMANDS[argv[0]](spark, argv[1:])
