import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from copyaudit.llm import topk

SF = "/root/testdata/sf0.001"


def floors(v):
    return None if v is None or any(x is None or not math.isfinite(x) for x in v) else \
        [math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v]


def plain(rows, queries, k):
    """Every pair scored with Python integers."""
    usable = [(i, x) for i, v in rows if (x := floors(v)) is not None]
    out = set()
    for qi, q in {(i, tuple(v)): (i, floors(v)) for i, v in queries if i is not None and floors(v) is not None}.values():
        scored = sorted((-min(max(sum(a * b for a, b in zip(q, x, strict=False)), -2 ** 63), 2 ** 63 - 1), i is None, i or 0)
                        for i, x in usable if i != qi)
        out |= {(qi, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(scored[:k], 1)}
    return out


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = topk.op13_exact_topk(spark, SF)
    cur = con.execute(topk.OP13_SQL)
    assert [d[0] for d in cur.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(cur.fetchall())


@pytest.mark.parametrize("seed", range(12))
def test_reading_stops_with_the_right_rows(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(topk, "RUN", rng.choice([3, 16, 64]))
    monkeypatch.setattr(topk, "BATCH", rng.choice([1, 4, 50]))
    width = rng.choice([1, 3, 8])
    draw = rng.choice([lambda: rng.gauss(0, 1), lambda: rng.choice([-0.01, 0.0, 0.01]), lambda: rng.expovariate(1) ** 4,
                       lambda: rng.choice([1e200, -3e18, 0.5, 1.0]) if rng.random() < 0.1 else rng.gauss(0, 1)])
    rows = [(i, [draw() for _ in range(width)]) for i in range(rng.choice([2, 6, 150]))]
    rows += rng.sample(rows, len(rows) // 4) + [(None, rows[0][1])]
    queries = [r for r in rows if r[0] is not None and r[0] % 3 == 0]
    as_table = lambda part: pa.table({"vec_id": pa.array([i for i, _ in part], pa.int64()),
                                      "vector": pa.array([v for _, v in part], pa.list_(pa.float64()))})
    distinct = list({(i, tuple(v)): (i, v) for i, v in queries}.values())
    number, score, row = topk.best_of_block(as_table(distinct), as_table(rows), 5, 256)
    got, rank = set(), {}
    for q, s, r in zip(number.tolist(), score, row.tolist(), strict=True):
        rank[q] = rank.get(q, 0) + 1
        got.add((distinct[q][0], rank[q], rows[r][0], s))
    assert got == plain(rows, queries, 5)


def test_few_entries_are_read_when_one_row_stands_out(monkeypatch):
    """Long-tailed lists: the bounds end the reading before the lists end."""
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.pareto(1.2, (2000, 6)))
    read = []
    put = np.put_along_axis
    monkeypatch.setattr(np, "put_along_axis", lambda a, i, v, axis: (read.append(len(i)), put(a, i, v, axis)))
    best = topk.Best(1, 5)
    ids = np.ma.array(np.arange(2000), mask=False)
    topk.read_run(x, np.arange(2000), ids, np.ones((1, 6)), np.array([-1]), np.array([0]), best)
    assert sorted(best.score.tolist()) == sorted(x.sum(axis=1).astype(int).tolist())[-5:]
    assert sum(read) / 2 < 2000


def test_defined_cases(spark):
    inf = float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.5]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0, None]), (4, [inf, 0.0]),
            (5, [float("nan")]), (None, [1.0, 2.0]), (6, []), (7, [1e308, -1e308]), (8, [-1e308, 0.0]), (50, [0.003, -0.003]), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, 1, "q", 2) for i, v in rows], "vec_id long, embedding array<double>, block int, key string, score int")
    got = topk.top_k(df, df.where("vec_id % 50 = 0 OR vec_id IS NULL"))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert set(map(tuple, got.collect())) == plain(rows, [r for r in rows if r[0] is not None and r[0] % 50 == 0], 5)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 50"), df.where("vec_id = 50")).count() == 0
    whole = spark.createDataFrame([(i, [float(i)]) for i in range(60)], "vec_id long, embedding array<float>")
    assert {r.vec_id for r in topk.top_k(whole, whole.where("vec_id = 50"), k=3).collect()} == {59, 58, 57}
