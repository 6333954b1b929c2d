"""Disk that finished steps still hold."""

from __future__ import annotations

import gc
import time

from pyspark.sql import SparkSession


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that nothing refers to any more.

    Spark does so when the driver collects its garbage, which may be long after a written step made them useless. What
    is still referred to stays, so a lost executor's files can be made again. Spark's listeners refer to the last query until
    they have heard of another one's end, so a query without a shuffle comes first, and a moment for them to hear of it.
    """
    spark.range(1, numPartitions=1).collect()
    time.sleep(0.3)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
