"""Counts over tables read as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.plans.registry import query, table
from sendero.session import table_path
from sendero.streaming.counts import (count_closed_windows, count_windows, count_words_per_batch, read_batches, read_closed,
                                      read_windows, stream_table, watermark_of, with_late_rows)


@query("""SELECT 0::BIGINT AS batch_id, word, count(*) AS n FROM (SELECT unnest(string_split(line, ' ')) AS word
          FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY 2""")
def stream_word_count(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    stream = stream_table(spark, f"{sf_dir}/documents.parquet*", schema)
    lines = stream.select(F.explode(F.split("text", "\n")).alias("line"))
    out = table_path(spark, "stream-words")
    count_words_per_batch(lines, out, f"{out}-progress").awaitTermination()
    return read_batches(spark, out)


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_count(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = stream_table(spark, f"{sf_dir}/events.parquet*", schema)
    out = table_path(spark, "stream-windows")
    count_windows(stream, "ts", "1 day", ["event_type"], out, f"{out}-progress").awaitTermination()
    return read_windows(spark, out, ["event_type"])


@query("""WITH a AS (SELECT ts, event_type, date_trunc('day', ts)::TIMESTAMP AS ws,
              least(2, (day(ts) - 1) // 10 + (md5(user_id::VARCHAR) < '4')::INT) AS arrival FROM events),
          w AS (SELECT arrival, max(max(date_trunc('milliseconds', ts))) OVER (ORDER BY arrival) - INTERVAL 2 DAY AS clock
                FROM a GROUP BY arrival)
          SELECT ws, event_type, count(*) FILTER (p.clock IS NULL OR ws + INTERVAL 1 DAY > p.clock) AS n,
              count(*) FILTER (ws + INTERVAL 1 DAY <= p.clock) AS late
          FROM a LEFT JOIN w AS p ON p.arrival = a.arrival - 1
          WHERE ws + INTERVAL 1 DAY <= (SELECT max(clock) FROM w) GROUP BY 1, 2""")
def stream_window_closed(spark, sf_dir):
    """Events arrive in thirds of a month, some users' a third later; windows end two days after the clock passes them."""
    events = table(spark, sf_dir, "events").select("ts", "event_type", "user_id")
    delayed = (F.md5(F.col("user_id").cast("string")) < "4").cast("int")
    arrivals = events.withColumn("arrival", F.least(F.lit(2), F.floor((F.day("ts") - 1) / 10) + delayed))
    inbox, out = table_path(spark, "events-in"), table_path(spark, "closed-windows")
    for arrival in range(3):
        (arrivals.where(F.col("arrival") == arrival).select("ts", "event_type")
         .write.mode("append").parquet(inbox))
        stream = stream_table(spark, inbox, "ts timestamp_ntz, event_type string")
        running = count_closed_windows(stream, "ts", "1 day", "2 days", ["event_type"], out, f"{out}-progress")
        running.awaitTermination()
    return with_late_rows(read_closed(spark, out, ["event_type"]), spark.read.parquet(inbox), "ts", "1 day", ["event_type"], watermark_of(running))
