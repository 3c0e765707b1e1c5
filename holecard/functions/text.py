"""Text column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip() sees it for ASCII text.  Spark's trim()
# and DuckDB's trim() only remove spaces, so strip is spelled as a class.
WS = r"[\t\n\x0B\f\r ]"
WS_CHARS = "\t\n\x0b\f\r "

# One line with its terminator, or a last line without one.  `\z` (not `$`)
# because Java's `$` also matches before a final line terminator.
LINE_PATTERN = r"[^\n]*\n|[^\n]+\z"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_newlines(text) -> Column:
    """Universal newlines, as Python's text-mode read does: CRLF and CR -> LF."""
    return F.regexp_replace(col(text), r"\r\n?", "\n")


def split_lines(text) -> Column:
    """ARRAY<STRING> of lines that keep their ``\\n``; no phantom last line."""
    return F.regexp_extract_all(normalize_newlines(text), F.lit(LINE_PATTERN), 0)


def strip(c) -> Column:
    return F.regexp_replace(col(c), rf"^{WS}+|{WS}+$", "")


def count_char(c, ch: str) -> Column:
    """Occurrences of one character in a string column."""
    return F.length(col(c)) - F.length(F.replace(col(c), F.lit(ch), F.lit("")))


def join_slice(arr, start, length) -> Column:
    """Concatenate ``length`` elements of ``arr`` from 1-based ``start``.

    Both bounds may be columns; a non-positive length gives ''.
    """
    start = col(start) if not isinstance(start, int) else F.lit(start)
    length = col(length) if not isinstance(length, int) else F.lit(length)
    return F.when(length <= 0, F.lit("")).otherwise(
        F.array_join(F.slice(col(arr), F.greatest(start, F.lit(1)), length), ""))
