"""Path-based audits over copies written to a scratch folder."""

import os
import re

from pyspark.sql import functions as F

from copyaudit.operators.worklist import ThreeWayParams, TwoWayParams
from copyaudit.plans.audits import audit_three_way, audit_two_way
from copyaudit.sources.copies import CopyLocation, copy_counts, scan_copies

ROWS = [(i, f"2022-03-0{1 + i % 3}") for i in range(30)]   # 10 rows in each of 3 days


def write(spark, path, rows=ROWS, fmt="orc"):
    df = spark.createDataFrame(rows, "id long, ods string")
    df.write.mode("overwrite").partitionBy("ods").format(fmt).save(path)


def two_way(scratch, databases="db1"):
    return TwoWayParams(src_system="s", country="c", source_parent=f"{scratch}/src",
                        target_prefix=f"{scratch}/tgt/", tables="t1", databases=databases,
                        partition_map="db1:ods")


def target_root(scratch, db="db1", table="t1"):
    return f"{scratch}/tgt{scratch}/src/{db}/{table}"


def by_date(df, *cols):
    return {r["partition_date"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_counts_files_and_bytes(spark, scratch):
    root = f"{scratch}/src/db1/t1"
    write(spark, root)
    open(f"{root}/ods=2022-03-01/_SUCCESS", "w").close()   # hidden marker: not a data file
    rows, errors = scan_copies(spark, [CopyLocation("db1", "t1", "source", root, "ods")])
    assert errors.count() == 0
    got = {r["partition_date"]: r for r in copy_counts(rows).collect()}
    assert {k: v["records"] for k, v in got.items()} == {"2022-03-01": 10, "2022-03-02": 10, "2022-03-03": 10}
    for day, r in got.items():
        files = [f for f in os.listdir(f"{root}/ods={day}") if not f.startswith((".", "_"))]
        assert r["files"] == len(files)
        assert r["bytes"] == sum(os.path.getsize(f"{root}/ods={day}/{f}") for f in files)


def test_two_way_done_failed_and_missing(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1")
    target = [r for r in ROWS if not (r[1] == "2022-03-02" and r[0] % 2 == 0)]   # day 2 loses 5 rows
    target = [r for r in target if r[1] != "2022-03-03"]                         # day 3 missing
    write(spark, target_root(scratch), target)
    audit = audit_two_way(spark, two_way(scratch), ["2022-03-01", "2022-03-02", "2022-03-03", "2022-03-09"])
    res = by_date(audit.results, "SourcePartRecordCount", "TargetPartRecordCount", "Status", "TargetPath")
    assert res["2022-03-01"][:3] == (10, 10, "Done")
    assert res["2022-03-02"][:3] == (10, 5, "Failed")
    assert res["2022-03-09"] == (-1, -1, "Done", "")          # E1: missing source, empty target path
    assert "2022-03-03" not in res                            # E3: target missing -> failure row
    fails = by_date(audit.failures, "stage", "message")
    assert fails["2022-03-03"][0] == "TargetListing"
    assert fails["2022-03-03"][1].startswith("db: db1, table: t1, cause: Failed to get information")
    ctl = {r["control_name"] for r in audit.controls.collect()}
    assert ctl == {"db1_t1_2022-03-01.match", "db1_t1_2022-03-02.nonmatch", "db1_t1_2022-03-09.match"}
    summary = audit.summary.first()
    assert (summary["done"], summary["failed"], summary["source_missing"], summary["errors"],
            summary["exit_code"]) == (1, 1, 1, 1, 1)


def test_unmapped_database_is_a_failure_row(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1")
    write(spark, target_root(scratch))
    audit = audit_two_way(spark, two_way(scratch, databases="db1,other"), ["2022-03-01"])
    assert audit.results.count() == 1
    fails = audit.failures.collect()
    assert [(f["db"], f["stage"]) for f in fails] == [("other", "PartitionColumn")]


def test_a_directory_without_data_is_never_done(spark, scratch):
    """A source partition that is there but empty is a failure; one that is not there is not."""
    days = ["2022-03-01", "2022-03-02", "2022-03-03", "2022-03-09"]
    write(spark, target_root(scratch))
    os.makedirs(f"{scratch}/src/db1/t1/ods=2022-03-01")                       # empty
    os.makedirs(f"{scratch}/src/db1/t1/ods=2022-03-02/_temporary/0")          # half written
    open(f"{scratch}/src/db1/t1/ods=2022-03-02/_SUCCESS", "w").close()
    open(f"{scratch}/src/db1/t1/ods=2022-03-02/.part-0.orc.crc", "w").close()
    audit = audit_two_way(spark, two_way(scratch), days)
    assert by_date(audit.results, "Status", "SourcePartRecordCount") == {"2022-03-03": ("Done", -1), "2022-03-09": ("Done", -1)}
    fails = by_date(audit.failures, "stage", "exception")
    assert set(fails) == {"2022-03-01", "2022-03-02"} and {v[0] for v in fails.values()} == {"SourceSize"}
    assert all("no data files" in v[1] for v in fails.values())
    assert {r["partition_date"] for r in audit.controls.collect()} == {"2022-03-03", "2022-03-09"}
    p = ThreeWayParams(src_system="s", country="c", container=f"{scratch}/store", parent_dir=f"{scratch}/wh",
                       open_staging_dir=f"{scratch}/stg", non_open_staging_dir="/x", storage_staging_dir="/x",
                       databases="sri_open", tables="t1|t,t2|p", ctrl_path=f"{scratch}/ctl")
    for t in ("t1", "t2"):
        for root in (f"{scratch}/store{scratch}/wh/sri_open/{t}", f"{scratch}/stg/{t}", f"{scratch}/wh/sri_open/{t}"):
            write(spark, root)
    import shutil
    empty = {("t1", f"{scratch}/stg/t1"): days[0], ("t2", f"{scratch}/store{scratch}/wh/sri_open/t2"): days[1],
             ("t1", f"{scratch}/wh/sri_open/t1"): days[2]}
    for (_, root), day in empty.items():
        shutil.rmtree(f"{root}/ods={day}")
        os.makedirs(f"{root}/ods={day}")
    audit = audit_three_way(spark, p, days[:3])
    assert {(r["table"], r["partition_date"]) for r in audit.failures.collect()} == {(t, d) for (t, _), d in empty.items()}
    assert audit.results.count() == 3 and audit.controls.count() == 3


def test_junk_file_becomes_failure_not_abort(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1")
    root = target_root(scratch)
    os.makedirs(f"{root}/ods=2022-03-01")
    with open(f"{root}/ods=2022-03-01/part-0.orc", "w") as fh:
        fh.write("not an orc file")
    locs = [CopyLocation("db1", "t1", "source", f"{scratch}/src/db1/t1", "ods"),
            CopyLocation("db1", "t1", "target", root, "ods")]
    rows, errors = scan_copies(spark, locs)
    bad = errors.collect()
    assert [(e["role"]) for e in bad] == ["target"]
    audit = audit_two_way(spark, two_way(scratch), ["2022-03-01"], stats_rows=rows, root_errors=errors)
    assert audit.results.count() == 0
    assert [f["stage"] for f in audit.failures.collect()] == ["TargetListing"]


def test_three_way_tokenized_plain_and_avro(spark, scratch):
    parent = f"{scratch}/wh"
    p = ThreeWayParams(src_system="s", country="c", container=f"{scratch}/store", parent_dir=parent,
                       open_staging_dir=f"{scratch}/stg_open", non_open_staging_dir=f"{scratch}/stg_non",
                       storage_staging_dir=f"{scratch}/stg_sto", databases="sri_open,storage",
                       tables='"t1|t,t2|p,t3|x"', ctrl_path=f"{scratch}/ctl")
    # sri_open.t1 tokenized (ORC): source, staging, target
    write(spark, f"{scratch}/store{parent}/sri_open/t1")
    write(spark, f"{scratch}/stg_open/t1")
    write(spark, f"{parent}/sri_open/t1", [r for r in ROWS if r[0] != 0])      # day 1 loses a row
    # storage.t2 plain (Avro), partition column vds
    avro = "org.apache.spark.sql.avro.AvroFileFormat"
    rows_v = [(i, d) for i, d in ROWS]
    spark.createDataFrame(rows_v, "id long, vds string").write.partitionBy("vds").format(avro) \
        .save(f"{scratch}/store{parent}/storage/t2")
    spark.createDataFrame(rows_v, "id long, vds string").write.partitionBy("vds").format(avro) \
        .save(f"{parent}/storage/t2")
    # sri_open.t3 has an invalid type but a source copy
    write(spark, f"{scratch}/store{parent}/sri_open/t3")
    audit = audit_three_way(spark, p, ["2022-03-01", "2022-03-02"])
    res = {(r["SchemaName"], r["TableName"], r["partition_date"]): r for r in audit.results.collect()}
    assert res[("sri_open", "t1", "2022-03-01")]["Status"] == "Failed"
    assert res[("sri_open", "t1", "2022-03-02")]["Status"] == "Done"
    assert res[("sri_open", "t1", "2022-03-02")]["StagingPartRecordCount"] == 10
    assert res[("storage", "t2", "2022-03-01")]["Status"] == "Done"
    assert res[("storage", "t2", "2022-03-01")]["StagingPath"] == "Plain"
    assert res[("storage", "t2", "2022-03-01")]["StagingPartRecordCount"] == -1
    # sources that do not exist: E8 rows with all counters -1 and no control record
    assert res[("storage", "t1", "2022-03-01")]["Status"] == "Done"
    assert res[("storage", "t1", "2022-03-01")]["SourcePartRecordCount"] == -1
    fails = {(f["db"], f["table"], f["partition_date"]): f["message"] for f in audit.failures.collect()}
    assert fails[("sri_open", "t3", "2022-03-01")].startswith("ComputeStats failed for table sri_open.t3")
    # sri_open.t2 is plain and has no copies at all -> E8 rows, not failures
    assert ("sri_open", "t2", "2022-03-01") not in fails
    ctl = {r["control_name"] for r in audit.controls.collect()}
    assert "sri_open_t1_2022-03-01.nonmatch" in ctl and "storage_t1_2022-03-01.match" not in ctl


def test_dropping_rows_fails_exactly_those_partitions(spark, scratch):
    """Property: removing k rows from chosen target partitions fails exactly those."""
    import random
    rnd = random.Random(7)
    days = [f"2022-03-{d:02d}" for d in range(1, 11)]
    rows = [(i, days[i % 10]) for i in range(200)]
    write(spark, f"{scratch}/src/db1/t1", rows)
    broken = set(rnd.sample(days, 4))
    drop = {d: rnd.randint(1, 5) for d in broken}
    kept, seen = [], {d: 0 for d in days}
    for r in rows:
        if r[1] in drop and seen[r[1]] < drop[r[1]]:
            seen[r[1]] += 1
            continue
        kept.append(r)
    write(spark, target_root(scratch), kept)
    audit = audit_two_way(spark, two_way(scratch), days)
    failed = {r["partition_date"] for r in audit.results.where(F.col("Status") == "Failed").collect()}
    assert failed == broken


def test_named_partitions_are_the_only_directories_asked_for(spark, scratch):
    from copyaudit.sources.copies import hive_escape, partition_dirs
    root = f"{scratch}/src/db1/t1"
    write(spark, root)
    loc = CopyLocation("db1", "t1", "source", f"{scratch}//src/db1/t1/", "ods")
    dirs, errors = partition_dirs(spark, [loc], ["2022-03-02", "2099-01-01", "a:b%\t"])
    assert sorted(d.dir for d in dirs.collect()) == [f"file:{root}/ods=2022-03-02", f"file:{root}/ods=2099-01-01",
                                                     f"file:{root}/ods=a%3Ab%25%09"]
    assert errors.count() == 0 and hive_escape("a:b%\t") == "a%3Ab%25%09"
    assert sorted(d.partition_date for d in partition_dirs(spark, [loc])[0].collect()) == ["2022-03-01", "2022-03-02", "2022-03-03"]
    assert partition_dirs(spark, [loc], [])[0].count() == 0
    wanted = spark.createDataFrame([("t1", "2022-03-01"), ("t2", "2022-03-02")], "`table` string, partition_date string")
    assert [d.partition_date for d in partition_dirs(spark, [loc], wanted)[0].collect()] == ["2022-03-01"]


def test_run_two_way_writes_every_sink(spark, scratch):
    from copyaudit.plans.run import run_two_way
    from copyaudit.sinks.files import read_controls, read_failures
    from copyaudit.sinks.tables import create_result_table
    write(spark, f"{scratch}/src/db1/t1")
    write(spark, f"{scratch}/src/db1/t2")
    root = target_root(scratch)
    write(spark, root)
    bad = target_root(scratch, table="t2")
    os.makedirs(f"{bad}/ods=2022-03-01")
    with open(f"{bad}/ods=2022-03-01/part-0.orc", "w") as fh:
        fh.write("junk")
    params = two_way(scratch)
    params.tables = "t1,t2"
    table = create_result_table(spark, "run_test", "audit_rows", three_way=False, location=f"{scratch}/audit_rows")
    summary = run_two_way(spark, params, ["2022-03-01", "2022-03-02"], table, f"{scratch}/ctl",
                          f"{scratch}/fail").first()
    assert (summary["done"], summary["errors"], summary["exit_code"]) == (2, 2, 1)
    assert spark.table(table).count() == 2
    assert read_controls(spark, f"{scratch}/ctl").count() == 2
    fails = read_failures(spark, f"{scratch}/fail").collect()
    assert {(f["table"], f["stage"]) for f in fails} == {("t2", "TargetListing")}


def test_marker_files_replace_the_opposite_outcome(spark, scratch):
    from copyaudit.sinks.files import write_marker_files
    rows = [(f"{scratch}/ctl/s/c/db1", "db1_t1_2022-03-01.nonmatch", "nonmatch", "2022-03-01"),
            (f"{scratch}/ctl/s/c/db1", "db1_t2_2022-03-01.match", "match", "2022-03-01")]
    schema = "control_dir string, control_name string, outcome string, partition_date string"
    assert write_marker_files(spark, spark.createDataFrame(rows, schema)) == 2
    rerun = [(f"{scratch}/ctl/s/c/db1", "db1_t1_2022-03-01.match", "match", "2022-03-01")]
    write_marker_files(spark, spark.createDataFrame(rerun, schema))
    names = sorted(os.listdir(f"{scratch}/ctl/s/c/db1"))
    assert [n for n in names if not n.startswith(".")] == ["db1_t1_2022-03-01.match", "db1_t2_2022-03-01.match"]
    assert os.path.getsize(f"{scratch}/ctl/s/c/db1/db1_t1_2022-03-01.match") == 0


def test_records_come_from_footers_and_nothing_runs_per_record(spark, scratch, monkeypatch):
    """ORC and Parquet copies: no scan of their records at all; Avro copies: one scan without columns, whatever their number."""
    from copyaudit.sources import copies
    scans = []
    counts = copies._counts_by_reader
    monkeypatch.setattr(copies, "_counts_by_reader", lambda s, fmt, dirs: scans.append((fmt, counts(s, fmt, dirs))) or scans[-1][1])
    locs = []
    for t, fmt in (("t1", "orc"), ("t2", "parquet"), ("t3", "avro"), ("t4", "avro")):
        for role, base in (("source", f"{scratch}/src"), ("target", f"{scratch}/tgt")):
            write(spark, f"{base}/db1/{t}", fmt=copies.reader_format(fmt))
            locs.append(CopyLocation("db1", t, role, f"{base}/db1/{t}", "ods", fmt))
    for values in (["2022-03-01"], None):
        scans.clear()
        rows, errors = scan_copies(spark, locs, values)
        assert errors.count() == 0
        got = {(r["table"], r["role"], r["partition_date"]): r["records"] for r in copy_counts(rows).collect()}
        assert set(got.values()) == {10} and len(got) == (8 if values else 24)
        assert [fmt for fmt, _ in scans] == ["avro"]
        plan = scans[0][1]._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall(r"FileScan avro \[", plan)) == 1 and "ReadSchema: struct<>" in plan


def test_footers_and_spark_readers_count_alike(spark, scratch, monkeypatch):
    """The way for stores that only Spark's and Hadoop's clients reach gives the same rows."""
    from copyaudit.sources import copies, inventory
    root = f"{scratch}/src/db1/t1"
    write(spark, root, [(i, "2022-03-01 10:00 +1%" if i % 2 else "2022-03-0é, {x}") for i in range(11)])
    write(spark, f"{scratch}/src/db1/t2", fmt="parquet")
    os.makedirs(f"{root}/ods=empty")
    open(f"{root}/ods=2022-03-0é, %7Bx}}/part-zero.orc", "w").close()
    locs = [CopyLocation("db1", "t1", "source", root, "ods"), CopyLocation("db1", "t2", "source", f"{scratch}/src/db1/t2", "ods", "parquet")]
    values = ["2022-03-01 10:00 +1%", "2022-03-0é, {x}", "2022-03-01", "empty", "absent"]

    def rows():
        stats, errors = scan_copies(spark, locs, values)
        return sorted(map(tuple, copy_counts(stats).collect())), sorted(map(tuple, errors.collect()))

    by_tasks = rows()
    assert [(r[1], r[3], r[4]) for r in by_tasks[0]] == [
        ("t1", "2022-03-01 10:00 +1%", 5), ("t1", "2022-03-0é, {x}", 6), ("t2", "2022-03-01", 10)]
    assert [e[3] for e in by_tasks[1]] == ["empty"]
    monkeypatch.setattr(inventory, "STORES", {})
    monkeypatch.setattr(copies, "FOOTERS", ())
    assert rows() == by_tasks


def test_files_in_subfolders_of_a_partition_are_counted(spark, scratch):
    """Content below a partition directory counts recursively (e.g. base_/delta_ folders)."""
    import shutil
    root = f"{scratch}/src/db1/t1"
    write(spark, root)
    day = f"{root}/ods=2022-03-01"
    first = sorted(f for f in os.listdir(day) if f.endswith(".orc"))[0]
    os.makedirs(f"{day}/base_0001")
    shutil.copy(f"{day}/{first}", f"{day}/base_0001/{first}")        # same rows again, one folder down
    rows, errors = scan_copies(spark, [CopyLocation("db1", "t1", "source", root, "ods")])
    assert errors.count() == 0
    got = {r["partition_date"]: (r["records"], r["files"]) for r in copy_counts(rows).collect()}
    files_top = len([f for f in os.listdir(day) if f.endswith(".orc")])
    extra = spark.read.orc(f"{day}/base_0001").count()
    assert got["2022-03-01"] == (10 + extra, files_top + 1)
    assert got["2022-03-02"][0] == 10


def test_two_way_over_parquet_copies(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1", fmt="parquet")
    write(spark, target_root(scratch), [r for r in ROWS if r[0] != 1], fmt="parquet")   # day 2 loses a row
    params = two_way(scratch)
    params.data_format = "parquet"
    res = by_date(audit_two_way(spark, params, ["2022-03-01", "2022-03-02"]).results,
                  "SourcePartRecordCount", "TargetPartRecordCount", "Status")
    assert res == {"2022-03-01": (10, 10, "Done"), "2022-03-02": (10, 9, "Failed")}


def test_escaped_partition_values_are_found(spark, scratch):
    """Values Spark escapes in directory names (':' -> %3A) are matched through the glob."""
    rows = [(i, "2022-03-01 10:00" if i % 2 else "2022-03-01 22:30") for i in range(10)]
    write(spark, f"{scratch}/src/db1/t1", rows)
    write(spark, target_root(scratch), rows[:-1])                 # row 9 ("10:00") is not copied
    assert any("%3A" in d for d in os.listdir(f"{scratch}/src/db1/t1"))
    res = by_date(audit_two_way(spark, two_way(scratch), ["2022-03-01 10:00", "2022-03-01 22:30"]).results,
                  "SourcePartRecordCount", "TargetPartRecordCount", "Status")
    assert res == {"2022-03-01 10:00": (5, 4, "Failed"), "2022-03-01 22:30": (5, 5, "Done")}


def test_partition_values_with_glob_characters(spark, scratch):
    rows = [(i, "a,b" if i % 2 else "c}d") for i in range(6)]
    write(spark, f"{scratch}/src/db1/t1", rows)
    write(spark, target_root(scratch), rows)
    res = by_date(audit_two_way(spark, two_way(scratch), ["a,b", "c}d"]).results, "SourcePartRecordCount", "Status")
    assert res == {"a,b": (3, "Done"), "c}d": (3, "Done")}


def test_zero_row_files_are_present_with_zero_records(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1")
    spark.createDataFrame([], "id long").write.orc(f"{scratch}/src/db1/t1/ods=2022-03-04")   # schema-only file
    write(spark, target_root(scratch))
    rows, _ = scan_copies(spark, [CopyLocation("db1", "t1", "source", f"{scratch}/src/db1/t1", "ods")])
    got = {r["partition_date"]: (r["records"], r["files"]) for r in copy_counts(rows).collect()}
    assert got["2022-03-04"][0] == 0 and got["2022-03-04"][1] >= 1
    audit = audit_two_way(spark, two_way(scratch), ["2022-03-04"])
    assert audit.results.count() == 0                                 # source present, target missing
    assert [f["stage"] for f in audit.failures.collect()] == ["TargetListing"]


def test_grouped_scan_keeps_copies_apart(spark, scratch):
    """Many tables in one relation: each file's counts land on its own copy."""
    for t, n in (("t1", 30), ("t2", 12), ("t3", 30)):
        rows = [(i, f"2022-03-0{1 + i % 3}") for i in range(n)]
        write(spark, f"{scratch}/src/db1/{t}", rows)
        if t != "t3":                                                  # t3 has no target copy
            write(spark, target_root(scratch, table=t), rows[1:] if t == "t1" else rows)   # t1 loses row 0
    params = two_way(scratch)
    params.tables = "t1,t2,t3"
    audit = audit_two_way(spark, params, ["2022-03-01", "2022-03-02"])
    res = {(r["TableName"], r["partition_date"]): (r["SourcePartRecordCount"], r["TargetPartRecordCount"],
                                                   r["Status"]) for r in audit.results.collect()}
    assert res == {("t1", "2022-03-01"): (10, 9, "Failed"), ("t1", "2022-03-02"): (10, 10, "Done"),
                   ("t2", "2022-03-01"): (4, 4, "Done"), ("t2", "2022-03-02"): (4, 4, "Done")}
    fails = sorted((f["table"], f["partition_date"]) for f in audit.failures.collect())
    assert fails == [("t3", "2022-03-01"), ("t3", "2022-03-02")]


def test_grouped_scan_over_avro_copies(spark, scratch):
    avro = "org.apache.spark.sql.avro.AvroFileFormat"
    for t, n in (("t1", 30), ("t2", 15)):
        rows = [(i, f"2022-03-0{1 + i % 3}") for i in range(n)]
        for base in (f"{scratch}/src/db1/{t}", target_root(scratch, table=t)):
            spark.createDataFrame(rows, "id long, ods string").write.partitionBy("ods").format(avro).save(base)
    params = two_way(scratch)
    params.tables, params.data_format = "t1,t2", "avro"
    res = {(r["TableName"], r["partition_date"]): (r["SourcePartRecordCount"], r["Status"])
           for r in audit_two_way(spark, params, ["2022-03-01"]).results.collect()}
    assert res == {("t1", "2022-03-01"): (10, "Done"), ("t2", "2022-03-01"): (5, "Done")}


def verdicts(spark, params, dates):
    audit = audit_two_way(spark, params, dates)
    rows = {(r["TableName"], r["partition_date"]): (r["SourcePartRecordCount"], r["TargetPartRecordCount"], r["Status"])
            for r in audit.results.collect()}
    return rows, sorted((f["table"], f["partition_date"], f["stage"]) for f in audit.failures.collect())


def test_slashes_and_numbers_of_dates_and_tables_change_nothing(spark, scratch):
    for t in ("t1", "t2"):
        write(spark, f"{scratch}/src/db1/{t}")
        write(spark, target_root(scratch, table=t), [r for r in ROWS if r[0] % 2])          # half of the rows
    days = ["2022-03-01", "2022-03-02"]
    expected = {(t, d): (10, 5, "Failed") for t in ("t1", "t2") for d in days}
    for parent_end in ("", "/", "//"):
        for prefix_end in ("", "/", "//"):
            params = two_way(scratch)
            params.tables = "t1,t2"
            params.source_parent, params.target_prefix = f"{scratch}/src{parent_end}", f"{scratch}/tgt{prefix_end}"
            assert verdicts(spark, params, days) == (expected, [])
    for extra in (31, 32, 500):
        params = two_way(scratch)
        params.tables = "t1,t2"
        dates = days + [f"d{i:03d}" for i in range(extra)]
        rows, failures = verdicts(spark, params, dates)
        assert {k: v for k, v in rows.items() if k[1] in days} == expected and failures == []
        assert {v for k, v in rows.items() if k[1] not in days} == {(-1, -1, "Done")}
        frame = spark.createDataFrame([(t, d) for t in ("t1", "t2") for d in dates], "`table` string, partition_date string")
        assert verdicts(spark, params, frame) == (rows, failures)
    params = two_way(scratch)
    assert verdicts(spark, params, days)[0] == {k: v for k, v in expected.items() if k[0] == "t1"}
    params.tables = ",".join(f"t{i}" for i in range(1, 301))
    assert {k: v for k, v in verdicts(spark, params, days)[0].items() if k[0] in ("t1", "t2")} == expected


def test_zero_byte_files_count(spark, scratch):
    os.makedirs(f"{scratch}/src/db1/t1/ods=2022-03-01")
    open(f"{scratch}/src/db1/t1/ods=2022-03-01/part-0.orc", "w").close()
    write(spark, target_root(scratch))
    dates = ["2022-03-01", *[f"d{i}" for i in range(40)]]
    for asked in (dates[:1], dates):
        rows, _ = verdicts(spark, two_way(scratch), asked)
        assert rows[("t1", "2022-03-01")] == (0, 10, "Failed")            # there, without records: never "missing"
    p = ThreeWayParams(src_system="s", country="c", container=f"{scratch}/store", parent_dir=f"{scratch}/wh",
                       open_staging_dir=f"{scratch}/stg", non_open_staging_dir="/x", storage_staging_dir="/x",
                       databases="sri_open", tables="t1|t", ctrl_path=f"{scratch}/ctl")
    for root in (f"{scratch}/store{scratch}/wh/sri_open/t1", f"{scratch}/stg/t1", f"{scratch}/wh/sri_open/t1"):
        spark.createDataFrame(ROWS, "id long, ods string").coalesce(1).write.partitionBy("ods").orc(root)
    open(f"{scratch}/store{scratch}/wh/sri_open/t1/ods=2022-03-01/part-1.orc", "w").close()
    res = by_date(audit_three_way(spark, p, ["2022-03-01", "2022-03-02"]).results,
                  "SourcePartFileCount", "StagingPartFileCount", "Status")
    assert res == {"2022-03-01": (2, 1, "Failed"), "2022-03-02": (1, 1, "Done")}


def test_unreadable_files_fail_their_partitions_only(spark, scratch):
    for t in ("t1", "t2", "t3"):
        write(spark, f"{scratch}/src/db1/{t}")
        write(spark, target_root(scratch, table=t))
    for t, day in (("t1", "01"), ("t2", "03"), ("t3", "03")):
        with open(f"{target_root(scratch, table=t)}/ods=2022-03-{day}/part-junk.orc", "w") as fh:
            fh.write("not an orc file")
    params = two_way(scratch)
    params.tables = "t1,t2,t3"
    audit = audit_two_way(spark, params, ["2022-03-01", "2022-03-02", "2022-03-03"])
    assert sorted((r["table"], r["partition_date"]) for r in audit.failures.collect()) == [
        ("t1", "2022-03-01"), ("t2", "2022-03-03"), ("t3", "2022-03-03")]
    rows = audit.results.collect()
    assert len(rows) == 6 and {r["Status"] for r in rows} == {"Done"}


def test_other_errors_are_raised(spark, scratch, monkeypatch):
    import pytest
    from copyaudit.sources import copies
    write(spark, f"{scratch}/src/db1/t1")
    locs = [CopyLocation("db1", "t1", "source", f"{scratch}/src/db1/t1", "ods")]

    def broken(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(copies, "_counts_by_reader", broken)
    monkeypatch.setattr(copies, "FOOTERS", ())                       # as for a format without a footer
    with pytest.raises(RuntimeError):
        copies.scan_copies(spark, locs)


def test_a_store_that_cannot_be_asked_is_an_error_of_its_copy(spark, scratch):
    write(spark, f"{scratch}/src/db1/t1")
    locs = [CopyLocation("db1", "t1", "source", f"{scratch}/src/db1/t1", "ods"),
            CopyLocation("db1", "t2", "source", "nostore://host/db1/t2", "ods")]
    rows, errors = scan_copies(spark, locs, ["2022-03-01"])
    assert [(e["table"], e["partition_date"]) for e in errors.collect()] == [("t2", "2022-03-01")]
    assert by_date(copy_counts(rows), "records") == {"2022-03-01": (10,)}


def test_unchanged_files_are_not_read_again(spark, scratch):
    """A folder of earlier counts: junk with an old file's length and time passes for it, a newer file of equal length does not."""
    root, avro = f"{scratch}/src/db1/t1", f"{scratch}/src/db1/t2"
    write(spark, root)
    write(spark, avro, fmt="org.apache.spark.sql.avro.AvroFileFormat")
    locs = [CopyLocation("db1", "t1", "source", root, "ods"), CopyLocation("db1", "t2", "source", avro, "ods", "avro")]
    counted = f"{scratch}/counts"

    def scan():
        rows, errors = scan_copies(spark, locs, counted=counted)
        return ({(r["table"], r["partition_date"]): r["records"] for r in copy_counts(rows).collect()},
                {(e["table"], e["partition_date"]) for e in errors.collect()})

    first = scan()
    assert set(first[0].values()) == {10} and len(first[0]) == 6 and first[1] == set()
    known = spark.read.parquet(counted).count()
    junked = []
    for base in (root, avro):
        for f in sorted(os.listdir(f"{base}/ods=2022-03-01")):
            path = f"{base}/ods=2022-03-01/{f}"
            if f.startswith("part-"):
                at = os.stat(path)
                open(path, "wb").write(b"x" * at.st_size)
                os.utime(path, ns=(at.st_atime_ns, at.st_mtime_ns))
                junked.append(path)
    assert scan() == first and spark.read.parquet(counted).count() == known
    write(spark, f"{scratch}/more", [(99, "2022-03-02")])
    extra = next(f for f in os.listdir(f"{scratch}/more/ods=2022-03-02") if f.startswith("part-"))
    os.rename(f"{scratch}/more/ods=2022-03-02/{extra}", f"{root}/ods=2022-03-02/part-more.orc")
    for path in junked:
        os.utime(path, ns=(1, 1))
    counts, errors = scan()
    assert counts[("t1", "2022-03-02")] == 11 and errors == {("t1", "2022-03-01"), ("t2", "2022-03-01")}
    assert ("t1", "2022-03-01") not in counts and spark.read.parquet(counted).count() == known + 1


def test_listings_keep_zero_length_files_and_hide_what_is_no_data(spark, scratch):
    from copyaudit.sources.inventory import file_listing, folder_totals
    import pytest
    for name, size in (("a.bin", 0), ("b.bin", 3), ("_SUCCESS", 0), (".c.crc", 2), ("sub/d.bin", 5), ("sub/x y%20.bin", 0), ("_temporary/e.bin", 1),
                       ("k=1/_k=2/f.txt", 7)):
        os.makedirs(os.path.dirname(f"{scratch}/{name}"), exist_ok=True)
        with open(f"{scratch}/{name}", "wb") as fh:
            fh.write(b"x" * size)
    flat = {r["file_name"]: r["length"] for r in file_listing(spark, scratch).collect()}
    assert flat == {"a.bin": 0, "b.bin": 3}
    deep = file_listing(spark, f"file://{scratch}/", recursive=True)
    assert {r["file_name"]: r["length"] for r in deep.collect()} == flat | {"d.bin": 5, "x y%20.bin": 0, "f.txt": 7}
    assert {r["file_name"] for r in file_listing(spark, scratch, recursive=True, glob="*.bin").collect()} == {
        "a.bin", "b.bin", "d.bin", "x y%20.bin"}
    totals = {r["folder"].rsplit("/", 1)[1]: (r["files"], r["bytes"]) for r in folder_totals(deep).collect()}
    assert totals[os.path.basename(scratch)] == (2, 3) and totals["sub"] == (2, 5)
    os.makedirs(f"{scratch}/void")
    assert file_listing(spark, f"{scratch}/void").count() == 0 and file_listing(spark, f"{scratch}/absent").count() == 0
    with pytest.raises(Exception, match="[Nn]o ?[Ff]ile ?[Ss]ystem|UnsupportedFileSystem"):
        file_listing(spark, "nostore://host/x").collect()
