"""Whole audit jobs and the registered query catalogue."""
