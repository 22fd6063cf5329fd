"""Truth tables of the verdicts (F1-F3) on hand-made stats rows."""

import pytest

from copyaudit.operators.worklist import ThreeWayParams, TwoWayParams
from copyaudit.plans.audits import audit_three_way, audit_two_way
from copyaudit.schemas import COPY_STATS


def stats(spark, rows):
    return spark.createDataFrame(rows, COPY_STATS)


TW = TwoWayParams("s", "c", "/src", "x://t/", "t1", "db1", "db1:ods")


@pytest.mark.parametrize("src,tgt,status", [(10, 10, "Done"), (10, 9, "Failed"), (0, 0, "Done"), (9, 10, "Failed")])
def test_two_way_records_decide(spark, src, tgt, status):
    rows = [("db1", "t1", "source", "d", src, 1, 100), ("db1", "t1", "target", "d", tgt, 7, 999)]
    r = audit_two_way(spark, TW, ["d"], stats_rows=stats(spark, rows)).results.first()
    assert r["Status"] == status          # files and bytes differ but are not judged
    assert (r["SourcePartFileCount"], r["TargetPartFileCount"]) == (1, 7)


def three(plain_rule="source_target"):
    return ThreeWayParams("s", "c", "x://c", "/p", "/o", "/n", "/v", "sri_open", '"tok|t,pl|p"', "/ctl",
                          plain_rule=plain_rule)


@pytest.mark.parametrize("s,g,t,sf,gf,status", [
    (10, 10, 10, 2, 2, "Done"),
    (10, 10, 10, 2, 3, "Failed"),     # file counts of source and staging differ
    (10, 9, 9, 2, 2, "Failed"),
    (10, 10, 9, 2, 2, "Failed"),
])
def test_tokenized_rule(spark, s, g, t, sf, gf, status):
    rows = [("sri_open", "tok", "source", "d", s, sf, 1), ("sri_open", "tok", "staging", "d", g, gf, 1),
            ("sri_open", "tok", "target", "d", t, 99, 1)]
    res = audit_three_way(spark, three(), ["d"], stats_rows=stats(spark, rows)).results
    assert res.where("TableName = 'tok'").first()["Status"] == status


@pytest.mark.parametrize("rule,status", [("source_target", "Done"), ("literal", "Failed")])
def test_plain_rules(spark, rule, status):
    rows = [("sri_open", "pl", "source", "d", 5, 1, 1), ("sri_open", "pl", "target", "d", 5, 1, 1)]
    r = audit_three_way(spark, three(rule), ["d"], stats_rows=stats(spark, rows)).results \
        .where("TableName = 'pl'").first()
    assert r["Status"] == status
    assert r["StagingPartRecordCount"] == -1 and r["StagingPath"] == "Plain"


def test_tokenized_without_staging_is_a_failure(spark):
    rows = [("sri_open", "tok", "source", "d", 5, 1, 1), ("sri_open", "tok", "target", "d", 5, 1, 1)]
    audit = audit_three_way(spark, three(), ["d"], stats_rows=stats(spark, rows))
    assert audit.results.where("TableName = 'tok'").count() == 0
    msg = audit.failures.where("table = 'tok'").first()["message"]
    assert msg.startswith("ComputeStats failed for table sri_open.tok due to staging path not found")


def test_three_way_partition_column_from_map(spark):
    params = ThreeWayParams("s", "c", "x://c", "/p", "/o", "/n", "/v", "sri_open,other", '"pl|p"', "/ctl",
                            partition_map="sri_open:log_day", use_partition_map=True)
    rows = [("sri_open", "pl", "source", "d", 5, 1, 1), ("sri_open", "pl", "target", "d", 5, 1, 1)]
    res = {r["SchemaName"]: r for r in
           audit_three_way(spark, params, ["d"], stats_rows=stats(spark, rows)).results.collect()}
    assert res["sri_open"]["SourcePath"] == "x://c/p/sri_open/pl/log_day=d"
    assert res["sri_open"]["Status"] == "Done"
    assert res["other"]["SourcePath"] == "x://c/p/other/pl/None=d"     # unmapped: no such copy -> E8 row
    assert res["other"]["SourcePartRecordCount"] == -1
