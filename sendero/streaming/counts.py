"""Counts over file streams. A query reads what has arrived and ends, or runs on an interval."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sendero.functions.dates import instant_utc, wall_clock_utc
from sendero.functions.text import words_by_space


def stream_table(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files that arrive at a path or glob, as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files that arrive at a path or glob, as a stream of ``line``."""
    reader = spark.readStream.option("lineSep", "\n")
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    return reader.text(path).withColumnRenamed("value", "line")


def start(stream: DataFrame, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str,
          interval: str | None = None) -> StreamingQuery:
    """Run ``write`` on every batch: each ``interval``, or without one until all that is there is read."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def count_words_per_batch(lines: DataFrame, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Words of each batch, counted by themselves, in folder ``batch_id=N`` of ``out``.

    A batch that is run again replaces its own folder, so no failure counts it twice.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        counts = (batch.select(F.explode(words_by_space("line")).alias("word"))
                  .groupBy("word").agg(F.count("*").alias("n")))
        counts.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return start(lines, "append", write, checkpoint, interval)


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """``(batch_id, word, n)`` of all batches so far."""
    return spark.read.schema("word string, n bigint, batch_id bigint").parquet(out).select("batch_id", "word", "n")


def windowed_counts(events: DataFrame, time: str, length: str, *by: str, lateness: str | None = None) -> DataFrame:
    """``(ws, *by, n)``: events per tumbling window of their own time, batch or stream alike.

    With ``lateness``, a stream's windows end that long after the latest event that an earlier batch brought; events of an ended
    window are left out from then on. A batch has no earlier one, so it keeps all.
    """
    timed = events.select(instant_utc(time).alias("_at"), *by)
    timed = timed if lateness is None else timed.withWatermark("_at", lateness)
    return (timed.groupBy(F.window("_at", length).alias("w"), *by).agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("_start"), *by, "n")
            .select(wall_clock_utc("_start").alias("ws"), *by, "n"))


def count_windows(events: DataFrame, time: str, length: str, by: list[str], out: str, checkpoint: str,
                  interval: str | None = None) -> StreamingQuery:
    """Write the windows each batch has changed, with their new counts, to folder ``batch_id=N`` of ``out``.

    The state is one row per window and group, the size of the result; late events still count.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return start(windowed_counts(events, time, length, *by), "update", write, checkpoint, interval)


def read_windows(spark: SparkSession, out: str, by: list[str]) -> DataFrame:
    """``(ws, *by, n)`` as of the last batch. Counts only grow, so the largest is the latest."""
    return spark.read.parquet(out).groupBy("ws", *by).agg(F.max("n").alias("n"))


def count_closed_windows(events: DataFrame, time: str, length: str, lateness: str, by: list[str], out: str, checkpoint: str,
                         interval: str | None = None) -> StreamingQuery:
    """Write each window once, when it has ended, to folder ``batch_id=N`` of ``out``.

    A window ends ``lateness`` after its last moment, by the events' own clock; its state is dropped then, so the state
    holds the windows of that span only, however long the stream runs.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return start(windowed_counts(events, time, length, *by, lateness=lateness), "append", write, checkpoint, interval)


def read_closed(spark: SparkSession, out: str, by: list[str]) -> DataFrame:
    """``(ws, *by, n)`` of the windows that have ended so far."""
    return spark.read.parquet(out).select("ws", *by, "n")


def watermark_of(query: StreamingQuery) -> datetime:
    """How far the query's clock has come, as wall-clock time; windows up to there have ended."""
    told = (query.lastProgress or {}).get("eventTime", {}).get("watermark", "1970-01-01T00:00:00.000Z")
    return datetime.fromisoformat(told.replace("Z", "+00:00")).replace(tzinfo=None)


def rows_dropped(query: StreamingQuery) -> int:
    """Late rows that the batches known to the query have left out, counted once per window, group and task."""
    return sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state after each batch."""
    return [o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]]


def with_late_rows(closed: DataFrame, events: DataFrame, time: str, length: str, by: list[str], until: datetime) -> DataFrame:
    """``(ws, *by, n, late)``: ended windows and how many of their events came after the end.

    ``events`` is all that has arrived, as a batch; ``until`` is the watermark. A window all of whose events were late has
    ``n = 0``. Null groups are groups.
    """
    ended = F.col("ws") + F.expr(f"INTERVAL {length}")
    names = {c: f"_{c}" for c in ["ws", *by]}
    arrived = windowed_counts(events, time, length, *by).withColumnsRenamed(names | {"n": "_n"})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ["ws", *by]]
    both = arrived.join(closed, same, "left").select(*[F.col(f"_{c}").alias(c) for c in ["ws", *by]], "_n", F.coalesce("n", F.lit(0)).alias("n"))
    return both.where(ended <= F.lit(until).cast("timestamp_ntz")).select("ws", *by, "n", (F.col("_n") - F.col("n")).alias("late"))
