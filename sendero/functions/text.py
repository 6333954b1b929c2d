"""The two tokenisers and the line splitter. They differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: the ASCII white space at which a byte string splits.
WHITESPACE = "[ \\t\\n\\x0B\\f\\r]+"


def words_by_whitespace(column: str | Column) -> Column:
    """Runs of non-white space; case kept, no empty tokens."""
    return F.array_remove(F.split(column, WHITESPACE), "")


def words_by_space(column: str | Column) -> Column:
    """Split at every single space; empty tokens kept."""
    return F.split(column, " ")


def lines_of(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line of ``text``, as ``line``, beside the ``keep`` columns."""
    return df.select(*keep, F.explode(F.split(text, "\n")).alias("line"))
