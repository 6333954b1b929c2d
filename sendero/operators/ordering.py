"""Global order without a single task: positions of sorted rows and exact quantiles.

Rows are range-partitioned and sorted in place. Only the row count of each partition then travels, a
table with one row per partition, which turns a row's place in its partition into its place overall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sendero.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number within it below


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    return materialize(df.repartitionByRange(*order).sortWithinPartitions(*order))


def with_position(df: DataFrame, *order: Column, name: str = "rn") -> DataFrame:
    """Add the 1-based position in the given order. End the order with a unique key: it also splits hot values."""
    placed = (_ranged(df, list(order)).withColumn("_id", F.monotonically_increasing_id())
              .withColumn("_part", F.shiftright("_id", _ROW_BITS)))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.col("_id").bitwiseAND(2**_ROW_BITS - 1)
    return (placed.join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + within + 1).drop("_id", "_part", "_before"))


def merge_ordered(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Outer merge of two tables on ``on``; a null key meets a null key."""
    theirs = right.withColumnsRenamed({c: f"_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    keys = [F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in on]
    rest = [c for c in [*left.columns, *right.columns] if c not in on]
    return left.join(theirs, same, "full").select(*keys, *rest)


def merge_ordered_positions(left: DataFrame, right: DataFrame, on: list[str], ties: list[str] | None = None,
                            name: str = "position") -> DataFrame:
    """``merge_ordered`` with each row's 1-based place in the order of ``on``, then ``ties``; nulls come last.

    Rows are placed by ranges, so a value that many rows have is spread over tasks if ``ties`` tells them apart.
    """
    order = [F.asc_nulls_last(c) for c in [*on, *(ties or [])]]
    return with_position(merge_ordered(left, right, on), *order, name=name)


def quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """``(col, p, value)``: exact quantiles, interpolated linearly between the two nearest ranks; NULLs skipped.

    Equal values are counted before they move. Only the partitions that hold a wanted rank are summed up.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    counts = (df.select(F.posexplode(values).alias("col", "value")).where("value is not null and not isnan(value)")
              .groupBy("col", "value").agg(F.count("*").alias("n")))
    placed = _ranged(counts, [F.col("col"), F.col("value")]).withColumn(
        "part", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS))

    sums = placed.groupBy("col", "part").agg(F.sum("n").alias("size"))
    earlier = Window.partitionBy("col").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (sums.withColumn("first", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
             .withColumn("total", F.sum("size").over(Window.partitionBy("col"))))
    wanted = (spans.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
              .withColumn("place", F.col("p") * (F.col("total") - 1))
              .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place")))))
              .where("rank >= first and rank < first + size")
              .select("col", "part", "p", "place", (F.col("rank") - F.col("first")).alias("rank")))
    wanted = F.broadcast(materialize(wanted))

    inside = Window.partitionBy("col", "part").orderBy("value")
    running = placed.join(wanted, ["col", "part"], "left_semi").withColumn("upto", F.sum("n").over(inside))
    hits = running.join(wanted, ["col", "part"]).where("rank < upto and rank >= upto - n")
    low, high = F.min("value"), F.max("value")
    fraction = F.min("place") - F.floor(F.min("place"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("col") + 1)
    return (hits.groupBy("col", "p").agg((low + (high - low) * fraction).alias("value"))
            .withColumn("col", name))
