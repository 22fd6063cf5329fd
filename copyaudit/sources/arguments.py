"""Driver arguments as small DataFrames.

Arguments are comma lists given on the command line; their size is bounded by
the argument itself, so these frames are small by construction. They are still
built with Spark expressions, so the same parsing applies to a column of many
argument sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup built from one argument string is broadcast only below this size.
MAX_BROADCAST_PAIRS = 100_000


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select()


def token_frame(spark: SparkSession, text: str, column: str) -> DataFrame:
    """``"a,b,c"`` -> one row per token with its 0-based position.

    Empty tokens are dropped (``"a,,b,"`` gives ``a``, ``b``).
    """
    return (_one_row(spark)
            .select(F.posexplode(F.split(F.lit(text), ",")).alias(f"{column}_pos", column))
            .where(F.col(column) != ""))


def partition_map_frame(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame]:
    """``db:col,db:col`` -> (lookup, problems).

    lookup: ``db_key`` (trimmed, lower-cased), ``partition_col`` (kept as given);
    the last pair for a key wins. problems: pairs that do not have exactly two
    parts, as ``pair_pos``, ``pair``.
    """
    pairs = (_one_row(spark)
             .select(F.posexplode(F.split(F.lit(text), ",")).alias("pair_pos", "pair"))
             .where(F.col("pair") != "")
             .withColumn("parts", F.split("pair", ":")))
    good = F.size("parts") == 2
    lookup = (pairs.where(good)
              .select("pair_pos",
                      F.lower(F.trim(F.element_at("parts", 1))).alias("db_key"),
                      F.element_at("parts", 2).alias("partition_col"))
              .groupBy("db_key")
              .agg(F.max_by("partition_col", "pair_pos").alias("partition_col")))
    problems = pairs.where(~good).select("pair_pos", "pair")
    return lookup, problems


def map_pair_count(text: str) -> int:
    return text.count(",") + 1


def lookup_join_side(lookup: DataFrame, text: str) -> DataFrame:
    """Broadcast the lookup only when the argument proves it small."""
    return F.broadcast(lookup) if map_pair_count(text) <= MAX_BROADCAST_PAIRS else lookup


def statement_rows(batches: DataFrame, batch_col: str = "batch") -> DataFrame:
    """One row per statement of each batch, with its ordinal in the batch."""
    from copyaudit.functions.statements import split_batch
    return batches.select("*", F.posexplode(split_batch(batch_col)).alias("ordinal", "raw_statement"))


# Arguments each job needs, in the original positional order;
# the two-way job refuses to start when one of the marked ones is missing.
TWO_WAY_ARGUMENTS = ["src_system", "country", "source_parent", "target_prefix", "tables",
                     "partition", "databases", "partition_map", "result_db", "result_table"]
TWO_WAY_REQUIRED = ["databases", "tables", "partition_map", "target_prefix", "result_db", "result_table"]


def parameter_problems(params: DataFrame, required: list[str], expected: list[str] | None = None) -> DataFrame:
    """One row per missing or empty required parameter of each run.

    ``params`` holds one row per parameter set (a ``run_id`` column is kept if
    present); a column that is absent altogether is reported for every run.
    """
    from functools import reduce
    key = [F.col("run_id")] if "run_id" in params.columns else [F.lit(None).cast("string").alias("run_id")]
    frames = []
    for name in (expected or required):
        if name not in params.columns:
            frames.append(params.select(*key, F.lit(name).alias("parameter"),
                                        F.lit("argument not given").alias("problem")))
        elif name in required:
            bad = F.col(name).isNull() | (F.trim(F.col(name)) == "")
            frames.append(params.where(bad).select(*key, F.lit(name).alias("parameter"),
                                                   F.lit("required argument is null or empty").alias("problem")))
    return reduce(DataFrame.unionByName, frames)
