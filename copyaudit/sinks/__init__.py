"""Outputs: result tables, control records, failure files."""
