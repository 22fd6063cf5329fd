"""Partition-registration statements: split a batch, normalise, find the table.

Text in quotes is a value and is never split or cleaned: a batch is read as a sequence of quoted tokens and of text
between them, and only the latter is changed. A quote that is not closed is an ordinary character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

STATEMENT_MARK = "\u0001"
UNKNOWN_TABLE = "unknown"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# A value in quotes, in which a backslash escapes; else the text up to the next quote, else a quote that is not closed.
QUOTED = r"""'[^'\\]*(?:\\.[^'\\]*)*'|"[^"\\]*(?:\\.[^"\\]*)*\""""
TOKEN = rf"""(?s){QUOTED}|[^'"]+|['"]"""


def outside_quotes(text, change: Callable[[Column], Column]) -> Column:
    """``text`` with ``change`` made to everything that is not a quoted value."""
    tokens = F.regexp_extract_all(_c(text), F.lit(TOKEN), F.lit(0))
    quoted = lambda t: (F.length(t) > 1) & t.rlike("^['\"]")
    return F.array_join(F.transform(tokens, lambda t: F.when(quoted(t), t).otherwise(change(t))), "")


def mark_statement_starts(batch) -> Column:
    """A comma that starts a new ALTER statement (in either case) becomes a separator.

    Commas inside ``PARTITION (a=1, b=2)`` are left alone, so a multi-column
    spec is not cut in two.
    """
    return outside_quotes(batch, lambda t: F.regexp_replace(t, r"(?i),\s*(ALTER\s)", STATEMENT_MARK + "$1"))


def split_batch(batch) -> Column:
    return F.split(mark_statement_starts(batch), STATEMENT_MARK)


def normalise_statement(raw) -> Column:
    """Drop ``[``, ``]``, newlines and ``;`` outside quotes, then a trailing ``,``; trim.

    Separator commas were consumed by the split, so a comma left inside a
    statement belongs to it (``PARTITION (a='1', b='2')``) and is kept.
    """
    cleaned = outside_quotes(raw, lambda t: F.regexp_replace(t, r"[\[\]\n;]", ""))
    return F.trim(F.regexp_replace(cleaned, r",\s*$", ""))


def statement_table(statement) -> Column:
    """Third space-separated token, ``unknown`` when there is none."""
    tokens = F.split(_c(statement), r"\s+")
    return F.when(F.size(tokens) >= 3, F.element_at(tokens, 3)).otherwise(F.lit(UNKNOWN_TABLE))


def is_add_partition(statement) -> Column:
    """Only ``ALTER TABLE <t> ADD [IF NOT EXISTS] PARTITION`` is executed."""
    return _c(statement).rlike(r"(?i)^ALTER\s+TABLE\s+\S+\s+ADD\s+(IF\s+NOT\s+EXISTS\s+)?PARTITION")
