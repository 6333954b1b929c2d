"""Joins on keys of which one may own a large share of the rows.

A key is *hot* when it owns more rows than a task should hold. Its rows are cut into slices of about that many, and the
one row it has on the other side is repeated once per slice. There is at most one hot key per such number of rows, and
whether that table is broadcast is left to its measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sendero.session import ROWS_PER_PART, materialize

MIN_HOT_ROWS = ROWS_PER_PART


def hot_keys(counts: DataFrame, key: str, n: str = "n", min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """``(key, slices)`` of the keys with more than ``min_rows`` rows, from a table with one row count ``n`` per key."""
    hot = counts.where(F.col(n) > min_rows).select(key, F.ceil(F.col(n) / min_rows).cast("int").alias("slices"))
    return materialize(hot)


def slice_rows(rows: DataFrame, key: str, spread_by: str, hot: DataFrame) -> DataFrame:
    """Add ``slice``: 0 for a cold key, a hash of ``spread_by`` for a hot one.

    The slice depends on the row alone, so a recomputed task sends every row where it went before.
    ``(key, spread_by)`` should be nearly unique.
    """
    known = hot.withColumnRenamed(hot.columns[0], key)
    number = F.when(F.col("slices").isNull(), 0).otherwise(
        F.pmod(F.xxhash64(spread_by), F.col("slices")).cast("int"))
    return rows.join(known, key, "left").withColumn("slice", number).drop("slices")


def repeat_rows(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """One copy of each lookup row per slice of its key."""
    known = hot.withColumnRenamed(hot.columns[0], key)
    slices = F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)
    return lookup.join(known, key, "left").withColumn("slice", F.explode(slices)).drop("slices")


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, hot: DataFrame,
                how: str = "inner") -> DataFrame:
    """Join ``rows`` to a ``lookup`` with one row per ``key``; both name the key column alike."""
    sliced = slice_rows(rows, key, spread_by, hot)
    return sliced.join(repeat_rows(lookup, key, hot), [key, "slice"], how).drop("slice")
