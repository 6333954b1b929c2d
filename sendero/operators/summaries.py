"""Column summaries, group statistics beside their rows, histograms, key reindexing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sendero.session import materialize

#: Groups whose aggregates every task may hold.
FEW_GROUPS = 1_000


def numeric_columns(df: DataFrame, *kinds: str) -> list[str]:
    """Names of numeric columns, or of those whose type is one of ``kinds`` ("int", "double", ...)."""
    return [f.name for f in df.schema.fields
            if (f.dataType.simpleString() in kinds if kinds else isinstance(f.dataType, T.NumericType))]


def _long_form(row: DataFrame, columns: list[str], fields: list[str]) -> DataFrame:
    """A one-row table of ``column__field`` values as one row per column."""
    items = [F.struct(F.lit(c).alias("col"), *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in columns]
    return row.select(F.explode(F.array(*items)).alias("x")).select("x.*")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(col, n, mean, sd, lo, hi)`` of numeric columns in one pass, missing values skipped."""
    columns = columns or numeric_columns(df)
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    stats = [fn(known[c]).alias(f"{c}__{name}") for c in columns for name, fn in (
        ("n", F.count), ("mean", F.avg), ("sd", F.stddev_samp), ("lo", F.min), ("hi", F.max))]
    return _long_form(df.agg(*stats), columns, ["n", "mean", "sd", "lo", "hi"])


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(col, n, lo, hi)`` of text columns."""
    stats = [fn(c).alias(f"{c}__{name}") for c in columns for name, fn in (
        ("n", F.count), ("lo", F.min), ("hi", F.max))]
    return _long_form(df.agg(*stats), columns, ["n", "lo", "hi"])


def _without_nan(df: DataFrame, column: str) -> Column:
    """The column with NULL for NaN, in its own type."""
    return F.nanvl(F.col(column), F.lit(None)) if dict(df.dtypes)[column] in ("double", "float") else F.col(column)


def column_means(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns])


def group_means(df: DataFrame, *keys: str) -> DataFrame:
    """Mean of every numeric column per group, as ``avg_<column>``; NaN makes its group's mean NaN, as in SQL."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"avg_{c}") for c in numeric_columns(df) if c not in keys])


def group_sums(df: DataFrame, *keys: str) -> DataFrame:
    """Sum of every numeric column per group, as ``sum_<column>``; text columns are left out, NaN is skipped."""
    return df.groupBy(*keys).agg(*[F.sum(_without_nan(df, c)).alias(f"sum_{c}") for c in numeric_columns(df)
                                   if c not in keys])


def correlations(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """``(col, r)``: Pearson correlation of ``target`` with each column, in one pass; NaN makes it NaN, as in SQL."""
    columns = columns or [c for c in numeric_columns(df) if c != target]
    return _long_form(df.agg(*[F.corr(target, c).alias(f"{c}__r") for c in columns]), columns, ["r"])


def with_group_stats(df: DataFrame, keys: list[str], *stats: Column) -> DataFrame:
    """Aggregates of each row's group beside the row; rows of one group stay spread over tasks.

    The aggregates are written out first. If they are few, each task gets them all and the rows stay where they are; if
    not, Spark splits a hot group. A NULL key is a group.
    """
    named = {k: f"_{k}" for k in keys}
    per_group = materialize(df.groupBy(*keys).agg(*stats)).withColumnsRenamed(named)
    if len(per_group.take(FEW_GROUPS + 1)) <= FEW_GROUPS:
        per_group = F.broadcast(per_group)
    same = [F.col(k).eqNullSafe(F.col(v)) for k, v in named.items()]
    return df.join(per_group, same).drop(*named.values())


def center(df: DataFrame, group: str, value: str, name: str = "centered") -> DataFrame:
    """``value`` minus its group mean, as double, every row kept; NaN does not count for the mean."""
    return (with_group_stats(df, [group], F.avg(_without_nan(df, value)).alias("_mean"))
            .withColumn(name, F.col(value) - F.col("_mean")).drop("_mean"))


def histogram(df: DataFrame, column: str, bins: int = 90) -> DataFrame:
    """``(bin, n)`` of equal-width bins, the last one closed; empty bins are absent.

    A constant column gets a range one unit wide around its value. NULL and NaN are in no bin.
    """
    known = df.select(F.col(column).cast("double").alias("x")).where("x is not null and not isnan(x)")
    low, high = known.agg(F.min("x")).scalar(), known.agg(F.max("x")).scalar()
    lo = F.when(low == high, low - 0.5).otherwise(low)
    hi = F.when(low == high, high + 0.5).otherwise(high)
    place = F.floor((F.col("x") - lo) / (hi - lo) * bins)
    return known.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def reindex(df: DataFrame, key: str, wanted: DataFrame, *extra: Column) -> DataFrame:
    """Exactly the ``wanted`` keys, NULL where the table has none, with ``extra`` columns added."""
    return wanted.select(key).join(df, key, "left").select("*", *extra)


def assign_between(df: DataFrame, key: str, first, last, name: str, value: float) -> DataFrame:
    """A column holding ``value`` where the key lies between ``first`` and ``last``, both included, else NULL."""
    return df.withColumn(name, F.when(F.col(key).between(first, last), F.lit(value)))
