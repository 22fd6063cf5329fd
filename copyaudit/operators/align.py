"""Line the copies of a partition up side by side.

All copies' stats rows are in one long frame; one ``groupBy`` over
``(db, table, partition_date)`` with role-conditional sums turns them into one
wide row per partition. That is the only shuffle of the audit besides the
join with the work list, and it carries partial aggregates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["db", "table", "partition_date"]


def align_copies(stats_rows: DataFrame, roles: list[str]) -> DataFrame:
    """Wide frame: ``<role>_present``, ``<role>_records``, ``_files``, ``_bytes``."""
    aggs = []
    for role in roles:
        mine = F.col("role") == F.lit(role)
        aggs += [
            (F.count(F.when(mine, F.lit(1))) > 0).alias(f"{role}_present"),
            F.sum(F.when(mine, F.col("records"))).alias(f"{role}_records"),
            F.sum(F.when(mine, F.col("files"))).alias(f"{role}_files"),
            F.sum(F.when(mine, F.col("bytes"))).alias(f"{role}_bytes"),
        ]
    return stats_rows.groupBy(*KEYS).agg(*aggs)


def root_errors_wide(root_errors: DataFrame, roles: list[str]) -> DataFrame:
    """One row per (db, table, partition) with the scan error of each role, if any.

    A row without a partition holds the errors of whole copies.
    """
    return (root_errors.groupBy(*KEYS)
            .agg(*[F.max(F.when(F.col("role") == r, F.col("exception"))).alias(f"{r}_error")
                   for r in roles]))


def attach_copies(items: DataFrame, aligned: DataFrame, errors_wide: DataFrame,
                  roles: list[str]) -> DataFrame:
    """Left joins: every work item keeps its row, present or not."""
    names = [f"{role}_error" for role in roles]
    own = errors_wide.where(F.col("partition_date").isNotNull())
    whole = errors_wide.where(F.col("partition_date").isNull()).select(
        "db", "table", *[F.col(n).alias(f"copy_{n}") for n in names])
    out = items.join(aligned, on=KEYS, how="left").join(own, on=KEYS, how="left") \
        .join(whole, on=["db", "table"], how="left")
    present = {f"{role}_present" for role in roles}
    kept = [c for c in out.columns if c not in names and not c.startswith("copy_")]
    return out.select(*[F.coalesce(F.col(c), F.lit(False)).alias(c) if c in present else F.col(c) for c in kept],
                      *[F.coalesce(f"copy_{n}", n).alias(n) for n in names])
