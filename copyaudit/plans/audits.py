"""The two audits as lazy DataFrame plans.

``audit_two_way`` / ``audit_three_way`` take the run parameters and the
partitions to check and return an :class:`Audit`: one verdict frame per work
item and its projections (result rows, control records, failure rows, run
summary). Without ``stats_rows`` the copies are scanned from their paths;
with it, any frame of ``COPY_STATS`` rows stands in for the scans.

The scan runs at once, as one job that keeps files and counts in the shared
checkpoint folder; a file that cannot be read is an error of its partition.
``counted`` names a folder of counts per file: files that did not change since
an earlier run are not read again.

Plan shape (whatever the number of tables and partitions):

    directories -> files -> records per file (one job, kept)
      -> agg on (db, table, partition) -> left join work list -> verdict projections
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from copyaudit.operators import results as R
from copyaudit.operators.align import align_copies, attach_copies, root_errors_wide
from copyaudit.operators.verdict import three_way_verdict, two_way_verdict
from copyaudit.operators.worklist import (ThreeWayParams, TwoWayParams, WorkList,
                                          copy_locations, three_way_work_list,
                                          two_way_work_list)
from copyaudit.schemas import ROLE_SOURCE, ROLE_STAGING, ROLE_TARGET
from copyaudit.session import checkpoint_root
from copyaudit.sources.copies import ROOT_ERROR, scan_copies

TWO_WAY_ROLES = [ROLE_SOURCE, ROLE_TARGET]
THREE_WAY_ROLES = [ROLE_SOURCE, ROLE_STAGING, ROLE_TARGET]


@dataclass
class Audit:
    """One verdict row per work item and its projections (built on first use)."""

    kind: str              # "two_way" or "three_way"
    work: WorkList
    stats_rows: DataFrame
    verdicts: DataFrame

    @cached_property
    def results(self) -> DataFrame:
        two = self.kind == "two_way"
        return R.two_way_results(self.verdicts) if two else R.three_way_results(self.verdicts)

    @cached_property
    def controls(self) -> DataFrame:
        two = self.kind == "two_way"
        return R.two_way_controls(self.verdicts) if two else R.three_way_controls(self.verdicts)

    @cached_property
    def failures(self) -> DataFrame:
        two = self.kind == "two_way"
        fn = R.two_way_failures if two else R.three_way_failures
        return fn(self.verdicts, self.work.problems)

    @cached_property
    def summary(self) -> DataFrame:
        return R.run_summary(self.verdicts, self.work.problems)

    def materialized(self) -> "Audit":
        """Cut the lineage after the scans: every sink then reads the small
        checkpointed verdict frame from the shared checkpoint folder, and a
        lost executor never sends the job back to the copies."""
        checkpoint_root(self.verdicts.sparkSession)
        return _project(self.kind, self.work, self.stats_rows, self.verdicts.checkpoint(eager=True))


def _project(kind: str, work: WorkList, stats_rows: DataFrame, verdicts: DataFrame) -> Audit:
    return Audit(kind, work, stats_rows, verdicts)


def _copies(spark, work, roles, stats_rows, root_errors, counted):
    if stats_rows is None:
        stats_rows, root_errors = scan_copies(spark, copy_locations(work.items, roles), work.items, counted)
    if root_errors is None:
        root_errors = spark.createDataFrame([], ROOT_ERROR)
    return stats_rows, root_errors


def audit_two_way(spark: SparkSession, params: TwoWayParams, partitions,
                  stats_rows: DataFrame | None = None,
                  root_errors: DataFrame | None = None, counted: str | None = None) -> Audit:
    work = two_way_work_list(spark, params, partitions)
    stats_rows, root_errors = _copies(spark, work, TWO_WAY_ROLES, stats_rows, root_errors, counted)
    items = attach_copies(work.items, align_copies(stats_rows, TWO_WAY_ROLES),
                          root_errors_wide(root_errors, TWO_WAY_ROLES), TWO_WAY_ROLES)
    return _project("two_way", work, stats_rows, two_way_verdict(items))


def audit_three_way(spark: SparkSession, params: ThreeWayParams, partitions,
                    stats_rows: DataFrame | None = None,
                    root_errors: DataFrame | None = None, counted: str | None = None) -> Audit:
    work = three_way_work_list(spark, params, partitions)
    stats_rows, root_errors = _copies(spark, work, THREE_WAY_ROLES, stats_rows, root_errors, counted)
    items = attach_copies(work.items, align_copies(stats_rows, THREE_WAY_ROLES),
                          root_errors_wide(root_errors, THREE_WAY_ROLES), THREE_WAY_ROLES)
    return _project("three_way", work, stats_rows, three_way_verdict(items, params.plain_rule))
