"""Streams over files: per-batch counts, windows, reruns."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sendero.streaming import counts

WAIT = 120


@pytest.fixture()
def two_files(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, text in enumerate(("a b  a\n", "a\n")):
        (folder / f"{i}.txt").write_text(text)
        os.utime(folder / f"{i}.txt", (1_000_000 + i, 1_000_000 + i))
    return str(folder)


def test_each_batch_counts_its_own_words(spark, two_files, tmp_path):
    lines = counts.stream_lines(spark, two_files, files_per_batch=1)
    query = counts.count_words_per_batch(lines, f"{tmp_path}/out", f"{tmp_path}/progress")
    assert query.awaitTermination(WAIT)
    got = sorted(map(tuple, counts.read_batches(spark, f"{tmp_path}/out").collect()))
    assert got == [(0, "", 1), (0, "a", 2), (0, "b", 1), (1, "a", 1)]


def test_interval_trigger_runs_until_stopped(spark, two_files, tmp_path):
    lines = counts.stream_lines(spark, two_files, files_per_batch=1)
    query = counts.count_words_per_batch(lines, f"{tmp_path}/out", f"{tmp_path}/progress", interval="1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert counts.read_batches(spark, f"{tmp_path}/out").agg(F.sum("n")).first()[0] == 5


def test_windows_equal_the_batch_result_late_events_included(spark, tmp_path):
    schema = "ts timestamp_ntz, kind string"
    day = dt.datetime(2024, 1, 1)
    batches = [[(day, "x"), (day + dt.timedelta(days=9), "x")], [(day + dt.timedelta(hours=3), "x"), (day, "y")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = counts.stream_table(spark, f"{tmp_path}/in", schema, files_per_batch=1)
    query = counts.count_windows(stream, "ts", "1 day", ["kind"], f"{tmp_path}/out", f"{tmp_path}/progress")
    assert query.awaitTermination(WAIT)
    got = sorted(map(tuple, counts.read_windows(spark, f"{tmp_path}/out", ["kind"]).collect()))
    whole = counts.windowed_counts(spark.read.parquet(f"{tmp_path}/in"), "ts", "1 day", "kind")
    assert got == sorted(map(tuple, whole.collect()))
    assert got == [(day, "x", 2), (day, "y", 1), (day + dt.timedelta(days=9), "x", 1)]


def test_windows_end_and_their_state_goes(spark, tmp_path):
    schema, day, hour = "ts timestamp_ntz, kind string", dt.timedelta(days=1), dt.timedelta(hours=1)
    first = dt.datetime(2024, 1, 1)
    arrivals = [[(first + hour, "x"), (first + 2 * hour, None), (first + 3 * day, "x")],
                [(first + 5 * hour, "x"), (first + day + hour, "x"), (first + 2 * day, "late"), (first + 3 * day + hour, "x")],
                [(first + 30 * day, "x"), (first + 31 * day, "x")],
                [(first + 6 * hour, "x"), (first + 7 * hour, "only late"), (first + 30 * day + hour, "x")]]
    states, dropped = [], 0
    for rows in arrivals:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_path}/in")
        stream = counts.stream_table(spark, f"{tmp_path}/in", schema)
        query = counts.count_closed_windows(stream, "ts", "1 day", "1 day", ["kind"], f"{tmp_path}/out", f"{tmp_path}/progress")
        assert query.awaitTermination(WAIT)
        states.append(counts.state_rows(query))
        dropped += counts.rows_dropped(query)
    closed = counts.read_closed(spark, f"{tmp_path}/out", ["kind"])
    # After arrival 0 the clock stands at day 2, after arrival 2 at day 30.
    assert sorted(map(tuple, closed.fillna("-").collect())) == [
        (first, "-", 1), (first, "x", 1), (first + 2 * day, "late", 1), (first + 3 * day, "x", 2)]
    until = counts.watermark_of(query)
    assert until == first + 30 * day
    told = counts.with_late_rows(closed, spark.read.parquet(f"{tmp_path}/in"), "ts", "1 day", ["kind"], until)
    assert sorted(map(tuple, told.fillna("-").collect())) == [
        (first, "-", 1, 0), (first, "only late", 0, 1), (first, "x", 1, 2), (first + day, "x", 0, 1), (first + 2 * day, "late", 1, 0),
        (first + 3 * day, "x", 2, 0)]
    assert dropped == 4  # two of one window in different arrivals, and two more
    assert states[0][-1] == 1 and max(states[1]) == 2 and states[2][-1] == 2 and states[3][-1] == 2


def test_failures_surface(spark, two_files, tmp_path):
    def fail(batch, batch_id):
        raise ValueError("no")
    query = counts.start(counts.stream_lines(spark, two_files), "append", fail, f"{tmp_path}/progress")
    with pytest.raises(StreamingQueryException):
        query.awaitTermination(WAIT)
