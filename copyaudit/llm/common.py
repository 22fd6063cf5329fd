"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.session import checkpoint_root, scratch_path

# White space of every word rule here: space and the controls tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared checkpoint folder; a lost executor costs no recomputation."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``kept`` for wide rows: written as Parquet below the shared folder and read back."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def span_list(texts_between: Column, matches: Column) -> Column:
    """Spans ``(start, end)`` in code points of regular-expression matches.

    ``texts_between`` is the text split at the matches, ``matches`` the matched strings in order; together they
    spell the text, so running lengths give every position.
    """
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(state, i):
        start = state["at"] + F.length(F.get(texts_between, i))
        end = start + F.length(F.get(matches, i))
        return F.struct(end.alias("at"),
                        F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("spans"))

    index = F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.size(matches) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(index, zero, step, lambda s: s["spans"])


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long): rows ``(node, component)``, component the smallest node.

    Alternates large-star and small-star steps until nothing moves; the edge list is stored after each round, so the
    lineage stays short. A node of any degree is handled by aggregates and equi-joins: no neighbour list is built.
    """
    current = kept(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct())

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """Per node u: connect its larger (large) or its smaller (small) neighbours to the least of u and all of them."""
        if large:
            both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = pairs                                   # every b is below its a
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        joined = both.join(least, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")) \
                .unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def mark(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = mark(current)
    for _ in range(rounds):
        if not seen[0]:
            break
        current = kept(star(star(current, True), False))
        now = mark(current)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: no end after {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
