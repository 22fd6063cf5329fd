"""Runs that are killed between their sinks and repeated."""

import os

import pytest

from copyaudit.plans import run as plans
from copyaudit.plans.audits import audit_two_way
from copyaudit.sinks.files import read_controls, read_failures
from copyaudit.sinks.journal import Journal
from copyaudit.sinks.tables import create_result_table
from test_physical import ROWS, target_root, two_way, write

DAYS = ["2022-03-01", "2022-03-02", "2022-03-03"]
SINKS = ["append_results", "write_controls", "write_marker_files", "write_failures"]


class Killed(BaseException):
    pass


def set_up(spark, scratch, name):
    write(spark, f"{scratch}/src/db1/t1")
    write(spark, target_root(scratch), [r for r in ROWS if r[0] not in (0, 3) and r[1] != DAYS[2]])
    table = create_result_table(spark, "run_test", name, three_way=False, location=f"{scratch}/{name}")
    return lambda days=DAYS: plans.run_audit(audit_two_way(spark, two_way(scratch), days), table, f"{scratch}/ctl", f"{scratch}/fail",
                                             markers=True).first(), table


def state(spark, scratch, table):
    spark.catalog.refreshTable(table)
    journal = f"{scratch}/ctl/_runs"
    return (sorted(map(tuple, spark.table(table).select("partition_date", "Status").collect())),
            sorted(r["control_name"] for r in read_controls(spark, f"{scratch}/ctl", journal).collect()),
            sorted(r["partition_date"] for r in read_failures(spark, f"{scratch}/fail", journal=journal).collect()))


WHOLE = ([(DAYS[0], "Failed"), (DAYS[1], "Done")], [f"db1_t1_{DAYS[0]}.nonmatch", f"db1_t1_{DAYS[1]}.match"], [DAYS[2]])


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("sink", [*SINKS, "commit"])
def test_a_killed_run_that_is_repeated_leaves_one_set_of_rows(spark, scratch, monkeypatch, sink, after):
    start, table = set_up(spark, scratch, f"killed_{sink}_{after}")
    owner = Journal if sink == "commit" else plans
    real = getattr(owner, sink)

    def killed(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise Killed

    monkeypatch.setattr(owner, sink, killed)
    with pytest.raises(Killed):
        start()
    monkeypatch.setattr(owner, sink, real)
    committed = sink == "commit" and after
    if not committed:
        if os.path.exists(f"{scratch}/fail"):                       # nothing of it counts
            assert state(spark, scratch, table)[1:] == ([], [])
        summary = start()
        assert (summary["items"], summary["done"], summary["failed"], summary["errors"], summary["exit_code"]) == (3, 1, 1, 1, 1)
    assert state(spark, scratch, table) == WHOLE


def test_runs_of_other_items_and_later_runs_keep_their_rows(spark, scratch, monkeypatch):
    start, table = set_up(spark, scratch, "others")
    real = plans.write_controls

    def killed(*args, **kwargs):
        raise Killed

    monkeypatch.setattr(plans, "write_controls", killed)
    with pytest.raises(Killed):
        start([DAYS[1]])                                            # another audit, dead
    monkeypatch.setattr(plans, "write_controls", real)
    start()
    rows = spark.table(table).count()
    assert rows == 3                                                # its row is still there, as it may be at work
    start([DAYS[1]])                                                # its repeat takes it away and appends its own
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 3
    start()                                                         # a complete run that is repeated appends, as ever
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 5
    log = Journal(spark, f"{scratch}/ctl/_runs")
    manifests = [log.read("manifest", r) for r in sorted(log._names("manifest"))]
    assert [len(m["result_files"]) for m in manifests] == [2, 1, 2] and not log.uncommitted()
    assert all(os.path.exists(f.removeprefix("file:")) for m in manifests for f in m["result_files"])
