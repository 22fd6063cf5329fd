"""Property tests: the verdict frame against a plain-Python model of the rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from copyaudit.operators.worklist import ThreeWayParams
from copyaudit.plans.audits import audit_three_way
from copyaudit.schemas import COPY_STATS

TABLES = {"tok": "t", "pl": "p", "bad": "x"}

count = st.one_of(st.none(), st.integers(min_value=0, max_value=3))
item = st.tuples(st.sampled_from(sorted(TABLES)), count, count, count,
                 st.integers(min_value=1, max_value=2), st.integers(min_value=1, max_value=2))


def model(table, s, g, t, sf, gf, plain_rule):
    """Expected (state, Status, source, staging, target records) of one item."""
    kind = TABLES[table]
    if s is None:
        return "source_missing", "Done", -1, -1, -1
    if kind not in ("t", "p"):
        return "invalid_type", None, -1, -1, -1
    if kind == "t" and g is None:
        return "staging_missing", None, -1, -1, -1
    if t is None:
        return "target_missing", None, -1, -1, -1
    if kind == "t":
        ok = s == g and g == t and sf == gf
        return "compared", "Done" if ok else "Failed", s, g, t
    ok = s == t if plain_rule == "source_target" else (s == -1 and s == t)
    return "compared", "Done" if ok else "Failed", s, -1, t


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(items=st.lists(item, min_size=1, max_size=25), plain_rule=st.sampled_from(["source_target", "literal"]))
def test_three_way_matches_model(spark, items, plain_rule):
    rows, parts = [], []
    for i, (table, s, g, t, sf, gf) in enumerate(items):
        day = f"d{i:03d}"
        parts.append((table, day))
        for role, n, files in (("source", s, sf), ("staging", g, gf), ("target", t, 1)):
            if n is not None:
                rows.append(("sri_open", table, role, day, n, files, n * 10))
    params = ThreeWayParams("s", "c", "x://c", "/p", "/o", "/n", "/v", "sri_open", '"tok|t,pl|p,bad|x"', "/ctl",
                            plain_rule=plain_rule)
    partitions = spark.createDataFrame(parts, "table string, partition_date string")
    stats = spark.createDataFrame(rows, COPY_STATS)
    verdicts = audit_three_way(spark, params, partitions, stats_rows=stats).verdicts
    got = {r["partition_date"]: (r["state"], r["Status"], r["source_records_out"], r["staging_records_out"],
                                 r["target_records_out"]) for r in verdicts.collect()}
    want = {f"d{i:03d}": model(*it, plain_rule) for i, it in enumerate(items)}
    assert got == want


value = st.text(alphabet="abcdefghijklmnopqrstuvwxyz0123456789-_", min_size=1, max_size=8)
spec = st.lists(st.tuples(st.sampled_from(["a", "b", "ods", "src"]), value), min_size=1, max_size=3,
                unique_by=lambda kv: kv[0])
statement = st.tuples(st.sampled_from(["d.t", "db2.other_t"]), st.booleans(), spec).map(
    lambda x: f"ALTER TABLE {x[0]} ADD {'IF NOT EXISTS ' if x[1] else ''}PARTITION ("
              + ", ".join(f"{k}='{v}'" for k, v in x[2]) + ")")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches=st.lists(st.lists(statement, min_size=1, max_size=5), min_size=1, max_size=4),
       sep=st.sampled_from([",", ",\n", ", ", ",\n  "]))
def test_batches_split_back_into_their_statements(spark, batches, sep):
    from copyaudit.plans.registration import split_statements
    rows = [(f"b{i}", "[" + sep.join(b) + ";]") for i, b in enumerate(batches)]
    out = split_statements(spark.createDataFrame(rows, "batch_id string, batch string")).collect()
    got = {}
    for r in out:
        got.setdefault(r["batch_id"], []).append((r["ordinal"], r["statement"], r["statement_table"]))
    want = {f"b{i}": [(j, s, s.split(" ")[2]) for j, s in enumerate(b)] for i, b in enumerate(batches)}
    assert {k: sorted(v) for k, v in got.items()} == want


def two_way_model(db, s, t):
    """Expected (state, Status, source records, target records, TargetPath empty?) of one two-way item."""
    if db == "other":
        return "lookup_missing", None, -1, -1
    if s is None:
        return "source_missing", "Done", -1, -1
    if t is None:
        return "target_missing", None, -1, -1
    return "compared", "Done" if s == t else "Failed", s, t


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(items=st.lists(st.tuples(st.sampled_from(["db1", "other"]), count, count), min_size=1, max_size=25))
def test_two_way_matches_model(spark, items):
    from copyaudit.operators.worklist import TwoWayParams
    from copyaudit.plans.audits import audit_two_way
    rows, parts = [], []
    for i, (db, s, t) in enumerate(items):
        day = f"d{i:03d}"
        parts.append((db, "t1", day))
        for role, n in (("source", s), ("target", t)):
            if n is not None:
                rows.append((db, "t1", role, day, n, 1, n))
    params = TwoWayParams("s", "c", "/src", "x://t/", "t1", "db1,other", "db1:ods")
    partitions = spark.createDataFrame(parts, "db string, table string, partition_date string")
    audit = audit_two_way(spark, params, partitions, stats_rows=spark.createDataFrame(rows, COPY_STATS))
    got = {(r["db"], r["partition_date"]): (r["state"], r["Status"], r["source_records_out"], r["target_records_out"])
           for r in audit.verdicts.collect()}
    want = {(db, f"d{i:03d}"): two_way_model(db, s, t) for i, (db, s, t) in enumerate(items)}
    assert got == want
    n_results = sum(1 for v in want.values() if v[0] in ("compared", "source_missing"))
    assert audit.results.count() == n_results
    assert audit.failures.count() == len(want) - n_results
