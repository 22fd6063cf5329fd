"""Inputs: argument lists, physical copy scans and file inventories."""
