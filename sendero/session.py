"""Session defaults, the shared working folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

ROWS_PER_PART = 4_000_000

_local_dir: str | None = None
_planning = threading.RLock()


def build_session(app: str = "sendero", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` overrides them (``spark.x`` keys)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: the context's checkpoint folder or what ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a folder of this machine.
    """
    global _local_dir
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="sendero-")
    return _local_dir


def table_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written table."""
    return os.path.join(shared_dir(spark), "sendero", f"{name}-{uuid.uuid4().hex}")


@contextmanager
def _set(spark: SparkSession, key: str, value: str):
    """A setting changed for a while; one caller at a time, so that none restores what another changed."""
    with _planning:
        before = spark.conf.get(key, None)
        spark.conf.set(key, value)
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions in which ``rows`` rows are no more than a task should hold."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PART))


def compacted(df: DataFrame, rows: int, per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` of at most ``rows`` rows in no more partitions than they take, ``per_part`` in each, and no fewer than keep all cores busy.

    The session's shuffle partitions suit its largest tables, but a checkpoint is a file and a task per partition, however few
    rows it holds. For each file on a mounted disk Hadoop starts processes to set its rights, and in the moment one
    starts the system shows the executor's whole memory twice.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_part)))


def _leaving_no_shuffles(df: DataFrame) -> DataFrame:
    """``df`` as a query of its own, whose shuffle files Spark deletes when its action ends."""
    with _set(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return df.select("*")  # the setting is read when a query is made


def release(*tables: DataFrame) -> None:
    """Delete the files of materialized tables that nothing reads any more; Spark does so only when the driver collects its garbage."""
    for table in tables:
        table.unpersist()
        file = table._jdf.logicalPlan().rdd().getCheckpointFile()
        if file.isDefined():
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, rows: int = 0) -> DataFrame:
    """Compute once and cut the lineage, with a copy that outlives any executor. What was shuffled for it is deleted.

    ``rows`` is about how many the largest step moves. If the session's shuffle partitions are too few for them, this runs
    with more, so that no task holds more rows, and starts to spill, because there are more in all.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    df = _leaving_no_shuffles(df)
    parts = -(-rows // ROWS_PER_PART)
    if parts <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return df.checkpoint(eager=True)
    with _set(spark, "spark.sql.shuffle.partitions", str(parts)):
        return df.checkpoint(eager=True)


def materialize_in_place(df: DataFrame) -> DataFrame:
    """``materialize`` a plan whose joins may meet by some of their columns, where both sides were partitioned by these."""
    with _set(df.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        return materialize(df)


def materialize_by(df: DataFrame, rows: int, *keys: str, also: tuple[str, ...] = ()) -> DataFrame:
    """``materialize`` hash-partitioned and sorted by ``keys``: later joins on them move and sort only the other side.

    Within the ``keys`` rows are sorted by ``also``. A checkpoint remembers its layout only if its plan was fixed before it ran,
    hence the switch. For loops the result is also kept in columns in the executors' memory; what does not fit there, or is lost, is
    read from the checkpoint again: ``unpersist`` it when done. ``rows`` is the size of ``df``, from which the number of parts follows.
    """
    parts = parts_for(df.sparkSession, rows)
    with _set(df.sparkSession, "spark.sql.adaptive.enabled", "false"):
        laid = materialize(df.repartition(parts, *keys).sortWithinPartitions(*keys, *also), rows)
    return laid.persist(StorageLevel.MEMORY_ONLY)
