"""Python functions over Arrow batches, for logic that has no built-in form."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sendero.operators.summaries import with_group_stats
from sendero.session import materialize

COGROUP_ROWS = 100_000


@F.arrow_udf(T.LongType())
def plus_one(values: pa.Array) -> pa.Array:
    return pc.add(values, 1)


@F.arrow_udf(T.IntegerType())
def add_one(values: pa.Array) -> pa.Array:
    return pc.add(values, pa.scalar(1, values.type)).cast(pa.int32())


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``add_one`` callable from SQL text."""
    spark.udf.register("add_one", add_one)


def keep_equal(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value``, filtered batch by batch."""
    def batches(arrived: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrived:
            yield batch.filter(pc.equal(batch.column(column), value))
    return df.mapInArrow(batches, df.schema)


def map_groups(df: DataFrame, group: str, stats: dict[str, Column], function: Callable[[pd.DataFrame], pd.DataFrame],
               schema: str) -> DataFrame:
    """Apply ``function`` to every row in the light of its group.

    What the function needs to know of the group comes as ``stats`` columns, computed by Spark over the whole group. It
    gets batches of rows of any groups, so it must treat each row by itself; its result does not depend on the size of
    a group, and no group has to fit a task.
    """
    rows = with_group_stats(df, [group], *[c.alias(n) for n, c in stats.items()])

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)
    return rows.mapInPandas(batches, schema)


def center_in_pandas(df: DataFrame, key: str, group: str, value: str) -> DataFrame:
    """``(key, group, centered)`` by a pandas function; NaN is missing, as in ``center``."""
    def center(frame: pd.DataFrame) -> pd.DataFrame:
        frame["centered"] = frame[value] - frame["group_mean"]
        return frame[[key, group, "centered"]]
    kinds = dict(df.dtypes)
    schema = f"{key} {kinds[key]}, {group} {kinds[group]}, centered double"
    known = F.nanvl(F.col(value).cast("double"), F.lit(None))
    return map_groups(df.select(key, group, value), group, {"group_mean": F.avg(known)}, center, schema)


def merge_ordered_in_pandas(left: DataFrame, right: DataFrame, on: list[str], schema: str,
                            group_rows: int = COGROUP_ROWS) -> DataFrame:
    """Outer merge of two tables by a pandas function per co-group; null keys meet null keys.

    Rows are co-grouped by a hash of all merge columns, not by one of them: equal keys still meet, and
    no group grows with the number of rows of one id. ``group_rows`` is about how many share a frame.
    """
    left, right = materialize(left), materialize(right)
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, not shared with left
    groups = max(1, -(-(left.count() + right.count()) // group_rows))
    bucket = F.pmod(F.xxhash64(*on), F.lit(groups)).alias("_bucket")

    def merge(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return pd.merge_ordered(a.drop(columns="_bucket"), b.drop(columns="_bucket"), on=on)
    return (left.select("*", bucket).groupBy("_bucket")
            .cogroup(right.select("*", bucket).groupBy("_bucket")).applyInPandas(merge, schema))
