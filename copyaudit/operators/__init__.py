"""Relational building blocks of the audits."""
