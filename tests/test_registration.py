"""Partition registration."""

from copyaudit.plans.registration import apply_statements, registration_failures, split_statements


def test_batch_applied_with_failures_as_rows(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS reg_test")
    spark.sql("DROP TABLE IF EXISTS reg_test.t")
    spark.sql(f"CREATE TABLE reg_test.t (v BIGINT, a STRING, b STRING) USING orc PARTITIONED BY (a, b) "
              f"LOCATION '{scratch}/t'")
    batch = ("[ALTER TABLE reg_test.t ADD PARTITION (a='1', b='x'),\n"
             "ALTER TABLE reg_test.t ADD PARTITION (a='1', b='x'),\n"
             "ALTER TABLE reg_test.t ADD PARTITION (c='1'),\n"
             "ALTER TABLE reg_test.nope ADD PARTITION (a='1', b='y'),\n"
             "ALTER TABLE reg_test.t ADD IF NOT EXISTS PARTITION (a='2', b='z');]")
    batches = spark.createDataFrame([("b1", batch)], "batch_id string, batch string")
    out = apply_statements(spark, split_statements(batches))
    got = [(r["ordinal"], r["outcome"]) for r in out.orderBy("ordinal").collect()]
    assert got == [(0, "ok"), (1, "failed"), (2, "failed"), (3, "failed"), (4, "ok")]
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS reg_test.t").collect())
    assert parts == ["a=1/b=x", "a=2/b=z"]
    fails = registration_failures(out, "s", "c", "/status").collect()
    assert {f["failure_file"] for f in fails} == {"MetaUpdate_s_c_reg_test.t_b1_failure.csv",
                                                   "MetaUpdate_s_c_reg_test.nope_b1_failure.csv"}
    assert all(f["message"].startswith("Partition update failed for s c ") for f in fails)


def test_other_statements_are_refused(spark):
    batches = spark.createDataFrame([("b1", "[DROP TABLE reg_test.t;]")], "batch_id string, batch string")
    out = apply_statements(spark, split_statements(batches)).first()
    assert out["outcome"] == "refused"


def test_chunked_registration_keeps_exact_outcomes(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS reg_test")
    spark.sql("DROP TABLE IF EXISTS reg_test.c")
    spark.sql(f"CREATE TABLE reg_test.c (v BIGINT, d STRING) USING orc PARTITIONED BY (d) LOCATION '{scratch}/c'")
    stmts = [f"ALTER TABLE reg_test.c ADD PARTITION (d='{i}')" for i in range(7)]
    stmts.insert(3, "ALTER TABLE reg_test.c ADD PARTITION (d='1')")        # repeat: must fail alone
    stmts.append("ALTER TABLE reg_test.c ADD PARTITION (zz='9')")          # bad column: fails its chunk
    stmts.append("ALTER TABLE reg_test.c ADD PARTITION (d='8')")
    batch = "[" + ",\n".join(stmts) + ";]"
    batches = spark.createDataFrame([("b1", batch)], "batch_id string, batch string")
    out = apply_statements(spark, split_statements(batches), chunk_size=3)
    got = [r["outcome"] for r in out.orderBy("ordinal").collect()]
    assert got == ["ok", "ok", "ok", "failed", "ok", "ok", "ok", "ok", "failed", "ok"]
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS reg_test.c").collect())
    assert parts == [f"d={i}" for i in (0, 1, 2, 3, 4, 5, 6, 8)]


def tables_and_batch(spark, scratch, names, n=7):
    spark.sql("CREATE DATABASE IF NOT EXISTS reg_test")
    stmts = []
    for t in names:
        spark.sql(f"DROP TABLE IF EXISTS reg_test.{t}")
        spark.sql(f"CREATE TABLE reg_test.{t} (v BIGINT, d STRING) USING orc PARTITIONED BY (d) LOCATION '{scratch}/{t}'")
    for i in range(n):
        stmts += [f"ALTER TABLE reg_test.{t} ADD PARTITION (d='{i % (n - 1)}')" for t in names]     # the last one repeats
    batch = "[" + ",\n".join(stmts) + ";]"
    return split_statements(spark.createDataFrame([("b1", batch)], "batch_id string, batch string"))


def parts_of(spark, names):
    return {t: sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS reg_test.{t}").collect()) for t in names}


def test_lanes_give_the_outcomes_of_a_serial_run(spark, scratch):
    names, seen = ["l1", "l2", "l3", "l4", "l5"], []
    for lanes, size in ((1, 1), (3, 2), (8, 100)):
        stmts = tables_and_batch(spark, f"{scratch}/{lanes}", names)
        out = apply_statements(spark, stmts, chunk_size=size, lanes=lanes)
        seen.append(([(r["ordinal"], r["outcome"]) for r in out.orderBy("ordinal").collect()], parts_of(spark, names)))
    assert seen[0] == seen[1] == seen[2]
    assert [o for _, o in seen[0][0]] == ["ok"] * 30 + ["failed"] * 5


def test_a_killed_batch_resumes_without_repeating(spark, scratch, monkeypatch):
    import pytest
    from copyaudit.plans import registration
    names = ["k1", "k2", "k3"]
    stmts = tables_and_batch(spark, scratch, names)

    class Killed(BaseException):
        pass

    for cut in ("before the call", "after the call"):
        real, calls = registration.Lane.run_group, []

        def run_group(self, group, real=real, calls=calls, cut=cut):
            calls.append(group)
            if len(calls) != 3:
                return real(self, group)
            if cut == "after the call":
                real(self, group)
            raise Killed

        stmts = tables_and_batch(spark, f"{scratch}/{cut[:2]}", names)
        log = f"{scratch}/log-{cut[:2]}"
        monkeypatch.setattr(registration.Lane, "run_group", run_group)
        with pytest.raises(Killed):
            apply_statements(spark, stmts, chunk_size=2, lanes=1, log=log)
        monkeypatch.setattr(registration.Lane, "run_group", real)
        finished = {(r["ordinal"], r["outcome"]) for r in registration.OutcomeLog(spark, log).read("done").collect()}
        assert 0 < len(finished) < 21
        sent = []
        monkeypatch.setattr(registration.Lane, "run_one", lambda self, row, f=registration.Lane.run_one: sent.append(row["ordinal"]) or f(self, row))
        out = apply_statements(spark, stmts, chunk_size=1, lanes=2, log=log)
        monkeypatch.undo()
        got = {(r["ordinal"], r["outcome"]) for r in out.collect()}
        assert got == {(i, "ok" if i < 18 else "failed") for i in range(21)} and finished < got
        assert not {i for i, _ in finished} & set(sent) and len(sent) == 21 - len(finished)
        assert parts_of(spark, names) == {t: [f"d={i}" for i in range(6)] for t in names}
        again = apply_statements(spark, stmts, log=log)
        assert again.count() == 21                                       # nothing left to do, the same outcomes


def test_outcomes_equal_a_one_by_one_run(spark, scratch):
    """Quotes, LOCATION, column order, case and several clauses: the same outcomes for every chunk size."""
    from copyaudit.plans.registration import partition_clauses
    assert partition_clauses("PARTITION (a='1', b=\"x)y\") LOCATION '/q' partition(B = 2,a='it\\'s')") == [
        frozenset({("a", "1"), ("b", "x)y")}), frozenset({("a", "it's"), ("b", "2")})]
    assert partition_clauses("PARTITION (a='1') junk") is None
    stmts = ["ALTER TABLE reg_test.q ADD PARTITION (d='1') LOCATION 'x/1'",
             "alter table reg_test.q add partition (d='1') location 'x/2'",
             "ALTER TABLE reg_test.q ADD PARTITION (d='5')", 'alter  table reg_test.q add partition (d="5")',
             "ALTER TABLE reg_test.q ADD PARTITION (d='6') PARTITION (d='7')",
             "ALTER TABLE reg_test.q ADD PARTITION (d='7') PARTITION (d='8')",
             "ALTER TABLE reg_test.q ADD IF NOT EXISTS PARTITION (d='5') LOCATION 'x/5'",
             "ALTER TABLE reg_test.q ADD IF NOT EXISTS PARTITION (d='9') PARTITION (d='9')"]
    spark.sql("CREATE DATABASE IF NOT EXISTS reg_test")
    seen = []
    for size in (1, 2, 3, 100):
        spark.sql("DROP TABLE IF EXISTS reg_test.q")
        spark.sql(f"CREATE TABLE reg_test.q (v BIGINT, d STRING) USING orc PARTITIONED BY (d) LOCATION '{scratch}/q{size}'")
        batches = spark.createDataFrame([("b", "[" + ",\n".join(stmts) + ";]")], "batch_id string, batch string")
        out = apply_statements(spark, split_statements(batches), chunk_size=size)
        parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS reg_test.q").collect())
        seen.append(([r["outcome"] for r in out.orderBy("ordinal").collect()], parts))
    assert all(x == seen[0] for x in seen)
    assert seen[0][0][:6] == ["ok", "failed", "ok", "failed", "ok", "failed"]
    assert seen[0][1][:4] == ["d=1", "d=5", "d=6", "d=7"]


def test_quoted_values_are_neither_split_nor_cleaned(spark, scratch):
    spark.sql("CREATE DATABASE IF NOT EXISTS reg_test")
    spark.sql("DROP TABLE IF EXISTS reg_test.q")
    spark.sql(f"CREATE TABLE reg_test.q (v BIGINT, d STRING) USING orc PARTITIONED BY (d) LOCATION '{scratch}/q'")
    values = ["x, ALTER y", "a;b,c[1]", 'say "hi", ALTER TABLE z', "it\\'s; [so]", "line\nbreak;", "plain"]
    stmts = [f"ALTER TABLE reg_test.q ADD PARTITION (d='{v}')" for v in values]
    stmts.append('alter table reg_test.q add partition (d="it\'s, alter [too];")')
    batches = spark.createDataFrame([("b1", "[" + ",\n".join(stmts) + ";]")], "batch_id string, batch string")
    split = split_statements(batches)
    assert [r["statement"] for r in split.orderBy("ordinal").collect()] == stmts
    out = apply_statements(spark, split)
    assert {r["outcome"] for r in out.collect()} == {"ok"}
    kept = {r["d"] for r in spark.sql("SHOW PARTITIONS reg_test.q").selectExpr(
        "url_decode(replace(substr(partition, 3), '+', '%2B')) AS d").collect()}
    assert kept == {"x, ALTER y", "a;b,c[1]", 'say "hi", ALTER TABLE z', "it's; [so]", "line\nbreak;", "plain", "it's, alter [too];"}


def test_a_quote_that_is_not_closed_is_an_ordinary_character(spark):
    batch = "[ALTER TABLE t ADD PARTITION (d='x),\nALTER TABLE t ADD PARTITION (d=2);]"
    rows = split_statements(spark.createDataFrame([("b1", batch)], "batch_id string, batch string"))
    assert [r["statement"] for r in rows.orderBy("ordinal").collect()] == [
        "ALTER TABLE t ADD PARTITION (d='x)", "ALTER TABLE t ADD PARTITION (d=2)"]
    long = "[ALTER TABLE t ADD PARTITION (d='" + "v;" * 50_000 + "')]"
    rows = split_statements(spark.createDataFrame([("b1", long)], "batch_id string, batch string"))
    assert rows.first()["statement"] == long[1:-1]
