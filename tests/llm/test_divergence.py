import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from copyaudit.llm import divergence, runs

SF = "/root/testdata/sf0.001"


def by_sql(documents, sql):
    con = duckdb.connect()
    con.register("documents", documents)
    cur = con.execute(sql)
    return [d[0] for d in cur.description], sorted(cur.fetchall())


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = divergence.op12_source_divergence(spark, SF)
    cur = con.execute(divergence.OP12_SQL)
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


def test_awkward_rows(spark, awkward, nothing):
    more = [(20 + i, t, lang, s, 1) for i, (t, lang, s) in enumerate([
        ("The mat, the house of é Ünï", "en", "b"), ("the house is a house", "en", None), ("mat 'house' on-the-cat", "en", "c"),
        ("...", "en", "d"), ("alone", "xx", "a"), ("", "xx", "b"), ("İ straße Straße STRASSE" * 3, "en", "b")])]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = awkward.select(columns).unionByName(spark.createDataFrame(more, awkward.select(columns).schema))
    table = pa.table({c: [r[c] for r in docs.collect()] for c in columns})
    got = divergence.divergences(awkward.unionByName(docs.where("doc_id >= 20"), allowMissingColumns=True), shards=3)
    names, want = by_sql(table, divergence.OP12_SQL)
    assert names == got.columns and sorted(map(tuple, got.collect())) == want and len(want) > 30
    assert divergence.divergences(nothing).count() == 0


def test_blocks_spill_and_runs_merge(monkeypatch):
    rng = random.Random(5)
    words = [f"w{chr(97 + i)}é" for i in range(20)]
    monkeypatch.setattr(divergence, "POSTINGS", 60)
    monkeypatch.setattr(runs, "RUN_ROWS", 3)
    want, docs_with, blobs, spills = Counter(), Counter(), defaultdict(list), 0
    block = divergence.Block()
    for _ in range(60):
        texts, groups = [], []
        for _ in range(rng.randint(1, 4)):
            found, group = rng.choices(words, k=rng.randint(0, 9)), (rng.choice(["en", "fr", ""]), rng.choice("ab"))
            texts.append((" ".join(found) + "! 7").encode())
            groups.append(group)
            want.update((w, *group) for w in found)
            docs_with.update({(w, *group) for w in found})
        block.add(pa.array(texts, pa.binary()), groups)
        if block.full():
            spills += 1
            for shard, data in block.runs(4):
                blobs[shard].append(data)
            block = divergence.Block()
    for shard, data in block.runs(4):
        blobs[shard].append(data)
    assert spills > 5
    got = {}
    for same in blobs.values():
        tables = [runs.summed(t, divergence.KEYS) for t in runs.merge_runs(same)]
        firsts = [(min(t["term"].to_pylist()), max(t["term"].to_pylist())) for t in tables]
        assert all(a[1] < b[0] for a, b in zip(firsts, firsts[1:], strict=False))
        for t in tables:
            for term, lang, source, n, docs in zip(*(t[c].to_pylist() for c in t.column_names), strict=True):
                assert (term.decode(), lang, source) not in got
                got[term.decode(), lang, source] = (n, docs)
    assert got == {k: (n, docs_with[k]) for k, n in want.items()}


def test_many_runs_merge_in_lanes(spark, monkeypatch):
    rows = [(0, lane, runs.encode_run(pa.table({"term": pa.array(sorted([b"x%d" % (lane % 7), b"y"]), pa.binary()),
                                                "lang": ["en", "en"], "source": ["a", "b"], "n": [lane, 1], "docs": [1, 1]})))
            for lane in range(150)]
    df = spark.createDataFrame(rows, runs.RUN_COLUMNS)
    fewer = runs.merged_lanes(df, 150, divergence.KEYS)
    assert fewer.count() <= runs.FAN_IN
    got = {(r.term, r.source): (r.n, r.docs) for r in divergence.merged_runs(fewer).collect()}
    assert got[("y", "b")] == (150, 150) and got[("x3", "a")] == (sum(range(3, 150, 7)), len(range(3, 150, 7)))


@pytest.mark.parametrize("n", [0, 5, 10 ** 15])
def test_shares_are_exact(spark, n):
    df = spark.createDataFrame([(n, 3 * n + 7, 5)], "n long, all_n long, terms long")
    assert df.select(divergence.share(*map(divergence.F.col, ("n", "all_n", "terms")))).first()[0] \
        == 1 + 10 ** 9 * (n + 1) // (3 * n + 12)


def test_corrections_of_many_sources(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows, want = [], Counter()
    least = {s: int(rng.integers(1, 50)) for s in "abcdefghij"}
    for term in range(40):
        holders = sorted(rng.choice(list(least), size=rng.integers(2, 10), replace=False))
        p = {s: least[s] + int(rng.integers(1, 10 ** 9)) for s in holders}
        rows += [("en", f"t{term}", s, p[s], least[s], len(holders)) for s in holders]
        f = lambda a, b: (a - b) ** 2 // b
        for s in holders:
            for t in holders:
                if s != t:
                    want[s, t] += f(p[s], p[t]) - f(p[s], least[t]) - f(least[s], p[t]) + f(least[s], least[t])
    df = spark.createDataFrame(rows, "lang string, term string, source string, p long, least long, sources long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")      # terms that straddle batches
    try:
        got = Counter()
        for r in divergence.corrections(df).collect():
            got[r.s, r.t] += r.value
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want
