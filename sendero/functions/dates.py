"""Date texts, calendars and wall-clock times without a session time zone in the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def parse_date(column: str | Column, pattern: str = "M/d/yyyy") -> Column:
    """Text to date; unreadable text gives NULL. ``M/d/yyyy`` reads one and two digits."""
    return F.try_to_date(F.col(column) if isinstance(column, str) else column, pattern)


def date_time_text(column: str | Column, pattern: str = "M/d/yyyy") -> Column:
    """Date text rewritten as ``yyyy-MM-dd HH:mm:ss`` text."""
    return parse_date(column, pattern).cast("timestamp_ntz").cast("string")


def unreadable(df: DataFrame, column: str, pattern: str = "M/d/yyyy") -> DataFrame:
    """Number of texts that ``parse_date`` turns into NULL."""
    return df.agg(F.count_if(F.col(column).isNotNull() & parse_date(column, pattern).isNull()).alias("n"))


def calendar(df: DataFrame, column: str) -> DataFrame:
    """Every day ``d`` from the first to the last value of a date or time column."""
    ends = df.agg(F.min(F.col(column).cast("date")).alias("lo"), F.max(F.col(column).cast("date")).alias("hi"))
    return ends.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("d"))


def instant_utc(column: str) -> Column:
    """A wall-clock time read as UTC, for the window function that needs an instant."""
    return F.timestamp_micros(F.expr(
        f"unix_date(CAST({column} AS DATE)) * 86400000000L + hour({column}) * 3600000000L"
        f" + minute({column}) * 60000000L + CAST(extract(SECOND FROM {column}) * 1000000 AS BIGINT)"))


def wall_clock_utc(column: str) -> Column:
    """The inverse of ``instant_utc``."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({column}), timestamp_ntz'1970-01-01 00:00:00')")
