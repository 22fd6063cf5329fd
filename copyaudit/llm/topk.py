"""Exact top-k inner products by aggregation of sorted lists, without random access.

A block of candidate rows is held as one sorted list of (row, value) per component. A query reads all lists in step, from
the top where its own component is positive and from the bottom where it is negative. What is read bounds every score from both sides: a
component that is not read yet is at most the list's last read value and at least its far end. Reading stops for a query
when its k-th lower bound lies above the most that a row not seen anywhere could score and above the upper bounds of all
but a few rows; the rest of the lists is then read for those few rows alone, which gives their final scores.

* Reading goes by segments of the lists and bounds of many rows and queries are taken together, so a step is a few matrix products.
* The lower bounds of rows already resolved carry over from one run of rows of a block to the next.
* Blocks of candidates and blocks of queries meet by hash keys: each task holds one block of either, both of a fixed
  size, and sends at most k rows per query; the best k of all blocks are taken by a window with a limit pushed below its shuffle.

Components become ``floor(scale * x)``. Sums stay exact: numbers too large for the exact range of a double take Python integers.

Defined cases: a null vector, or one with null or non-finite components, takes no part; of vectors of different lengths
the shorter one counts as followed by zeros; an empty vector scores 0; a query's own rows are all rows of its vec_id, and
repeated rows of it (equal vectors) are one query; repeated candidate rows are candidates each; a null vec_id is a
candidate that comes last in a tie and never a query; scores beyond 64 bits count as the nearest 64-bit number; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from copyaudit.llm.common import table

K = 5
EVERY = 50               # rows whose vec_id is divisible by it are queries
SCALE = 256
CANDIDATES = 65_536      # rows of a candidate block
QUERIES = 8_192          # rows of a query block
RUN, BATCH = 2_048, 1_024    # rows and queries whose bounds are held at a time
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 1)    # shares of the lists after which bounds are compared
FEW = 1 / 32             # share of a run's rows that may be left for a query when reading stops
LONG = 1 << 63


def whole_parts(vectors: pa.Array, width: int, scale: int = SCALE) -> tuple[np.ndarray, list[int]]:
    """``floor(scale * x)`` as doubles, rows padded with zeros, and the rows whose numbers may exceed exact doubles."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), width))
    with np.errstate(over="ignore"):
        out[np.arange(width) < lengths[:, None]] = np.floor(scale * flat)
    most = math.isqrt((1 << 53) // max(width, 1))
    return out, np.flatnonzero((np.abs(out) >= most).any(axis=1)).tolist() if width else []


def python_integers(vectors: pa.Array, rows: list[int], width: int, scale: int = SCALE) -> np.ndarray:
    out = np.full((len(rows), width), 0, dtype=object)
    for i, row in enumerate(rows):
        for j, x in enumerate(vectors[row].as_py()):
            out[i, j] = math.floor(scale * x) if abs(x) < 1e300 else scale * int(x)
    return out


def within_long(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, -LONG, LONG - 1) if scores.dtype == object else scores


class Best:
    """The k best resolved rows per query so far, in the order of the result."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.row = np.empty(0, np.int64)
        self.least = [-math.inf] * queries                       # k-th best score, once there are k

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        """``row``: place among the block's rows in the order of ties."""
        query, row = np.concatenate([self.query, query]), np.concatenate([self.row, row])
        score = np.concatenate([self.score, score.astype(np.int64)])
        order = np.lexsort((row, ~score, query))                 # ~ turns the order round without overflow
        query, score, row = query[order], score[order], row[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        kept = nth < self.k
        self.query, self.score, self.row = query[kept], score[kept], row[kept]
        full = nth[kept] == self.k - 1
        for q, s in zip(self.query[full].tolist(), self.score[full].tolist(), strict=True):
            self.least[q] = s


def read_run(x: np.ndarray, place: np.ndarray, ids: np.ma.MaskedArray, q: np.ndarray, q_ids: np.ndarray, numbers: np.ndarray,
             best: Best) -> None:
    """Reads the lists of one run of rows for a batch of queries; adds the rows that may be among the k best.

    ``place``: the rows' order in ties; ``ids``: masked where null; ``numbers``: the queries' numbers in ``best``.
    """
    n, k = len(x), best.k
    far = -math.inf
    order = np.argsort(x, axis=0, kind="stable")
    lists = np.take_along_axis(x, order, 0)
    zero = q * 0
    rising, falling = np.maximum(q, zero).T, np.minimum(q, zero).T
    from_top, from_bottom = np.full(x.shape, far, x.dtype), np.full(x.shape, -far, x.dtype)   # what has been read
    own = (ids[:, None] == q_ids[None, :]).filled(False)
    least = np.array([best.least[i] for i in numbers], dtype=object if x.dtype == object else np.float64)
    active, read = np.arange(len(q)), 0
    for share in DEPTHS:
        depth = max(1, math.ceil(share * n))
        if depth > read:
            np.put_along_axis(from_top, order[n - depth:n - read], lists[n - depth:n - read], 0)
            np.put_along_axis(from_bottom, order[read:depth], lists[read:depth], 0)
            read = depth
        last_top, last_bottom = lists[n - depth], lists[depth - 1]
        unseen = within_long(last_top @ rising[:, active] + last_bottom @ falling[:, active])
        new = least[active] == far                               # no k resolved rows yet: lower bounds of this run
        ready = active[(unseen < least[active]) | new | (depth == n)]
        if not len(ready):
            continue
        upper = within_long(np.maximum(from_top, last_top) @ rising[:, ready]
                            + np.minimum(from_bottom, last_bottom) @ falling[:, ready])
        bar = least[ready].copy()
        fresh = np.flatnonzero(bar == far)
        if len(fresh) and n > k:
            lower = within_long(np.where(from_top == far, lists[0], from_top) @ rising[:, ready[fresh]]
                                + np.where(from_bottom == -far, lists[-1], from_bottom) @ falling[:, ready[fresh]])
            mine = own[:, ready[fresh]]
            if mine.any():
                lower = np.where(mine, far, lower)
            bar[fresh] = np.sort(lower, axis=0)[n - k]
        left = (upper >= bar) & ~own[:, ready]
        done = (left.sum(axis=0) <= max(k, FEW * n)) | (depth == n)
        done &= (unseen[np.searchsorted(active, ready)] < bar) | (depth == n)
        rows, which = np.nonzero(left[:, done])
        chosen = ready[done][which]
        scores = within_long((x[rows] * q[chosen]).sum(axis=1))  # the rest of the lists, for these rows
        best.add(numbers[chosen], scores, place[rows])
        active = np.setdiff1d(active, ready[done], assume_unique=True)
        if not len(active):
            break


def best_of_block(queries: pa.Table, rows: pa.Table, k: int, scale: int) -> tuple[np.ndarray, list[int], np.ndarray]:
    """``(query number, score, row number)`` of the k best rows of a block for each query."""
    ids = rows["vec_id"].combine_chunks()
    key = np.array([(x is None, x or 0) for x in ids.to_pylist()], dtype=[("none", "?"), ("id", "i8")])
    by_tie = np.argsort(key, order=["none", "id"], kind="stable")
    place = np.empty(len(by_tie), np.int64)
    place[by_tie] = np.arange(len(by_tie))
    row_ids = np.ma.array(key["id"], mask=key["none"])
    q_ids = queries["vec_id"].to_numpy()
    vectors, q_vectors = rows["vector"].combine_chunks(), queries["vector"].combine_chunks()
    width = int(max(max(np.diff(v.offsets.to_numpy()), default=0) for v in (vectors, q_vectors)))
    (x, x_big), (q, q_big) = whole_parts(vectors, width, scale), whole_parts(q_vectors, width, scale)
    best = Best(len(q), k)
    x_small, q_small = np.delete(np.arange(len(x)), x_big), np.delete(np.arange(len(q)), q_big)
    parts = [(x_small, x[x_small], q_small, q[q_small])]
    if x_big or q_big:
        exact_x, exact_q = python_integers(vectors, x_big, width, scale), python_integers(q_vectors, q_big, width, scale)
        integers = lambda part: np.array([[int(v) for v in r] for r in part.tolist()], dtype=object).reshape(len(part), width)
        parts.append((np.array(x_big, np.int64), exact_x, np.array(q_big, np.int64), exact_q))
        if x_big:
            parts.append((np.array(x_big, np.int64), exact_x, q_small, integers(q[q_small])))
        if q_big:
            parts.append((x_small, integers(x[x_small]), np.array(q_big, np.int64), exact_q))
    for x_at, x_part, q_at, q_part in parts:
        for a in range(0, len(x_at), RUN):
            for b in range(0, len(q_at), BATCH):
                run, batch = slice(a, a + RUN), slice(b, b + BATCH)
                read_run(x_part[run], place[x_at[run]], row_ids[x_at[run]], q_part[batch], q_ids[q_at[batch]], q_at[batch], best)
    return best.query, best.score.tolist(), by_tie[best.row]


def blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: the k best rows of ``vectors`` for each row of ``queries``.

    Both hold ``vec_id`` and ``embedding``; ties go to the smaller vec_id.
    """
    def usable(df: DataFrame) -> DataFrame:
        number = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.where(F.col("embedding").isNotNull() & number).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))

    rows, asked = usable(vectors), usable(queries).where("vec_id IS NOT NULL").distinct()
    spark = vectors.sparkSession
    n, m = rows.count(), asked.count()
    # small tables are still spread over all tasks
    n_blocks = max(blocks(n, CANDIDATES), min(spark.sparkContext.defaultParallelism, blocks(n, RUN)))
    m_blocks = blocks(m, QUERIES)

    def block(count: int, *by: str):
        return F.pmod(F.xxhash64(*by), F.lit(count)).cast("int")

    left = asked.withColumn("q_block", block(m_blocks, "vec_id", "vector")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = rows.withColumn("block", block(n_blocks, "vec_id", "vector")) \
        .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(m_blocks - 1))))

    def meet(queries: pa.Table, rows: pa.Table) -> pa.Table:
        number, score, row = best_of_block(queries, rows, k, scale) if len(queries) and len(rows) else ([], [], [])
        picked = queries.take(pa.array(number, pa.int64()))
        return pa.table({"query_id": picked["vec_id"], "query_key": picked["key"],
                         "vec_id": rows["vec_id"].take(pa.array(row, pa.int64())), "score": pa.array(score, pa.int64())})

    met = left.withColumn("key", F.xxhash64("vector")).groupBy("block", "q_block").cogroup(right.groupBy("block", "q_block")) \
        .applyInArrow(meet, "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


OP13_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % {EVERY} = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
