"""Item states and verdicts.

Every item ends in exactly one state. ``compared`` and ``source_missing``
produce a result row; every other state produces a failure row instead. Counts
of absent copies are replaced by the -1 sentinel *before* any comparison, so a
null never takes part in a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from copyaudit.functions.routing import TYPE_PLAIN, TYPE_TOKENIZED
from copyaudit.schemas import SENTINEL, STATUS_DONE, STATUS_FAILED

COMPARED = "compared"
SOURCE_MISSING = "source_missing"
RESULT_STATES = (COMPARED, SOURCE_MISSING)

PLAIN_RULES = ("source_target", "literal")


def _sentinel(col: Column) -> Column:
    return F.coalesce(col, F.lit(SENTINEL)).cast("long")


def two_way_state() -> Column:
    return (F.when(F.col("problem").isNotNull(), F.lit("lookup_missing"))
            .when(F.col("source_error").isNotNull(), F.lit("source_error"))
            .when(~F.col("source_present"), F.lit(SOURCE_MISSING))
            .when(F.col("target_error").isNotNull(), F.lit("target_error"))
            .when(~F.col("target_present"), F.lit("target_missing"))
            .otherwise(F.lit(COMPARED)))


def two_way_verdict(items: DataFrame) -> DataFrame:
    """records equal -> Done. Files and bytes are reported, not judged."""
    df = items.select("*", two_way_state().alias("state"))
    compared = F.col("state") == F.lit(COMPARED)
    df = df.select("*", *[F.when(compared, _sentinel(F.col(f"{role}_{m}"))).otherwise(F.lit(SENTINEL))
                          .alias(f"{role}_{m}_out")
                          for role in ("source", "target") for m in ("records", "files", "bytes")])
    status = (F.when(F.col("state") == F.lit(SOURCE_MISSING), F.lit(STATUS_DONE))
              .when(compared & (F.col("source_records_out") == F.col("target_records_out")), F.lit(STATUS_DONE))
              .when(compared, F.lit(STATUS_FAILED)))
    return df.select("*", status.alias("Status"))


def three_way_state() -> Column:
    tokenized = F.col("table_type") == F.lit(TYPE_TOKENIZED)
    return (F.when(F.col("source_error").isNotNull(), F.lit("source_error"))
            .when(~F.col("source_present"), F.lit(SOURCE_MISSING))
            .when(~F.col("valid_type"), F.lit("invalid_type"))
            .when(tokenized & F.col("staging_error").isNotNull(), F.lit("staging_error"))
            .when(tokenized & ~F.col("staging_present"), F.lit("staging_missing"))
            .when(F.col("target_error").isNotNull(), F.lit("target_error"))
            .when(~F.col("target_present"), F.lit("target_missing"))
            .otherwise(F.lit(COMPARED)))


def three_way_verdict(items: DataFrame, plain_rule: str = "source_target") -> DataFrame:
    """F2 (tokenized) and F3 (plain) verdicts.

    Tokenized: src = stg records, stg = tgt records and src = stg files.
    Plain: ``source_target`` compares source and target records;
    ``literal`` compares the source with the staging sentinel as well, which
    makes every plain partition ``Failed`` (kept for parity checks).
    """
    if plain_rule not in PLAIN_RULES:
        raise ValueError(f"plain_rule must be one of {PLAIN_RULES}")
    df = items.select("*", three_way_state().alias("state"))
    compared = F.col("state") == F.lit(COMPARED)
    tokenized = F.col("table_type") == F.lit(TYPE_TOKENIZED)
    outs = []
    for role in ("source", "staging", "target"):
        keep = compared & tokenized if role == "staging" else compared
        outs += [F.when(keep, _sentinel(F.col(f"{role}_{m}"))).otherwise(F.lit(SENTINEL)).alias(f"{role}_{m}_out")
                 for m in ("records", "files", "bytes")]
    return df.select("*", *outs).select("*", three_way_status(plain_rule).alias("Status"))


def three_way_status(plain_rule: str = "source_target") -> Column:
    """Status of a three-way item from its sentinel-filled counters."""
    if plain_rule not in PLAIN_RULES:
        raise ValueError(f"plain_rule must be one of {PLAIN_RULES}")
    compared = F.col("state") == F.lit(COMPARED)
    tokenized = F.col("table_type") == F.lit(TYPE_TOKENIZED)
    src, stg, tgt = (F.col(f"{r}_records_out") for r in ("source", "staging", "target"))
    token_ok = (src == stg) & (stg == tgt) & (F.col("source_files_out") == F.col("staging_files_out"))
    plain_ok = (src == tgt) if plain_rule == "source_target" else ((src == stg) & (src == tgt))
    ok = F.when(tokenized, token_ok).when(F.col("table_type") == F.lit(TYPE_PLAIN), plain_ok)
    return (F.when(F.col("state") == F.lit(SOURCE_MISSING), F.lit(STATUS_DONE))
            .when(compared & ok, F.lit(STATUS_DONE))
            .when(compared, F.lit(STATUS_FAILED)))
