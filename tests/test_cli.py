"""The command line with the original jobs' positional arguments."""

import os

from copyaudit.cli import main
from test_physical import target_root, write


def test_two_way_command(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1")
    write(spark, target_root(scratch), [(i, d) for i, d in [(0, "2022-03-01"), (1, "2022-03-02")]])
    args = ["two-way", "s", "c", f"{scratch}/src", f"{scratch}/tgt/", "t1", "2022-03-01", "db1,other",
            "db1:ods", "cli_db", "audit_two"]
    assert main(args, spark) == 1                       # 'other' has no partition column: a failure row
    row = spark.table("cli_db.audit_two").first()
    assert (row["SourcePartRecordCount"], row["TargetPartRecordCount"], row["Status"]) == (10, 1, "Failed")
    assert os.path.exists(f"{scratch}/tgt/s/c/db1/db1_t1_2022-03-01.nonmatch")


def test_wrong_argument_count_and_nulls(spark):
    assert main(["two-way", "only", "three", "args"], spark) == 1
    assert main(["two-way", "s", "c", "/p", "x://t/", "", "d", "db", "m", "r", "t"], spark) == 1
    assert main(["unknown"], spark) == 1


def test_register_command(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_reg")
    spark.sql("DROP TABLE IF EXISTS cli_reg.t")
    spark.sql(f"CREATE TABLE cli_reg.t (v BIGINT, d STRING) USING orc PARTITIONED BY (d) LOCATION '{scratch}/t'")
    os.makedirs(f"{scratch}/status/keep_me")
    stmts = "[ALTER TABLE cli_reg.t ADD PARTITION (d='1'),\nALTER TABLE cli_reg.t ADD PARTITION (x='2');]"
    assert main(["register", "s", "c", stmts, f"{scratch}/status", "20220301"], spark) == 0
    assert [r[0] for r in spark.sql("SHOW PARTITIONS cli_reg.t").collect()] == ["d=1"]
    names = sorted(os.listdir(f"{scratch}/status"))
    assert "failure_file=MetaUpdate_s_c_cli_reg.t_20220301_failure.csv" in names
    assert "keep_me" in names


def test_three_way_command(spark, scratch):
    parent = f"{scratch}/wh"
    write(spark, f"{scratch}/store{parent}/sri_open/t1")
    write(spark, f"{scratch}/stg/t1")
    write(spark, f"{parent}/sri_open/t1")
    args = ["three-way", "s", "c", f"{scratch}/store", parent, f"{scratch}/stg", "/unused", "/unused",
            "sri_open", '"t1|t"', "unused:map", "2022-03-02", "cli_db", "audit_three", f"{scratch}/ctl"]
    assert main(args, spark) == 0
    row = spark.table("cli_db.audit_three").first()
    assert (row["SourcePartRecordCount"], row["StagingPartRecordCount"], row["Status"]) == (10, 10, "Done")
    assert os.path.exists(f"{scratch}/ctl/global/sri_open_t1_2022-03-02.match")


def test_a_second_catalog_appends_to_the_same_results(spark, scratch):
    """A run whose catalog does not know the table finds the rows of earlier runs at its location."""
    write(spark, f"{scratch}/src/db1/t1")
    write(spark, target_root(scratch))
    args = ["two-way", "s", "c", f"{scratch}/src", f"{scratch}/tgt", "t1", "2022-03-01", "db1", "db1:ods", "cli_db", "again"]
    assert main(args, spark) == 0
    location = f"{scratch}/tgt/s/c/_results/cli_db.again"
    spark.sql("DROP TABLE cli_db.again")                 # what a new in-memory catalog looks like
    assert os.listdir(location)
    args[6] = "2022-03-02"
    assert main(args, spark) == 0
    assert sorted(r["partition_date"] for r in spark.table("cli_db.again").collect()) == ["2022-03-01", "2022-03-02"]


def test_runs_over_different_tables_keep_each_others_records(spark, scratch):
    from copyaudit.sinks.files import read_controls, read_failures
    for t in ("t1", "t2"):
        write(spark, f"{scratch}/src/db1/{t}")
    write(spark, target_root(scratch))                   # t2 has no target copy: a failure row
    base = f"{scratch}/tgt/s/c"

    def run(tables):
        main(["two-way", "s", "c", f"{scratch}/src", f"{scratch}/tgt/", tables, "2022-03-01", "db1", "db1:ods", "cli_db",
              "keep"], spark)
        return (sorted(r["control_name"] for r in read_controls(spark, f"{base}/_control_records").collect()),
                sorted(r["table"] for r in read_failures(spark, f"{base}/_failures").collect()))

    assert run("t1,t2") == (["db1_t1_2022-03-01.match"], ["t2"])
    assert run("t1") == (["db1_t1_2022-03-01.match"], ["t2"])
    write(spark, target_root(scratch, table="t2"))
    assert run("t2") == (["db1_t1_2022-03-01.match", "db1_t2_2022-03-01.match"], [])
