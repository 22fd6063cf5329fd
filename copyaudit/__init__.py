"""copyaudit: set-based audits of partitioned-table copies on Spark.

Layout:
  sources/    argument lists, physical copy scans, file inventories
  functions/  column expressions (paths, routing, statements, messages)
  operators/  work list, copy alignment, verdicts, results, controls, failures
  plans/      two-way and three-way audits, partition registration, query catalogue
  sinks/      result tables, control records, failure files
  streaming/  nothing: the audited jobs are batch only
"""

__all__ = ["session", "schemas"]
