"""Tables to files and catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from sendero.session import ROWS_PER_PART, table_path


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).json(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "errorifexists",
              null: str = "") -> str:
    """CSV as ``read_csv`` reads it; ``null`` is how NULL is written."""
    df.write.mode(mode).options(header=header, sep=sep, quote='"', escape='"', nullValue=null,
                                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def write_lines(df: DataFrame, path: str, *by: str, mode: str = "errorifexists") -> str:
    """A text column, one record per line, in folders by the ``by`` columns."""
    df.write.mode(mode).partitionBy(*by).option("lineSep", "\n").text(path)
    return path


def write_partitioned(df: DataFrame, path: str, *by: str, format: str = "parquet", mode: str = "errorifexists") -> str:
    """Folders by value. Every task writes its own rows, so a frequent value is no single writer's work."""
    df.write.mode(mode).partitionBy(*by).format(format).save(path)
    return path


def write_table(df: DataFrame, name: str, format: str = "parquet", path: str | None = None,
                mode: str = "errorifexists") -> str:
    """A catalog table; with ``path`` its files lie there instead of in the warehouse."""
    writer = df.write.mode(mode).format(format)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None, mode: str = "errorifexists") -> str:
    """A catalog table in ``buckets`` files by a hash of ``keys``, each sorted by them.

    Joins and groups by ``keys`` of tables with as many buckets move and sort nothing. The rows move once, here, so that a bucket
    is one file; a key with a large share of the rows makes its bucket large, so lay such tables out by more columns.
    """
    placed = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = placed.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def buckets_for(rows: int) -> int:
    """Buckets of a size that one task can hold, for the larger of the tables that are to meet."""
    return max(8, -(-rows // ROWS_PER_PART))


@contextmanager
def laid_out(df: DataFrame, keys: list[str], buckets: int) -> Iterator[DataFrame]:
    """``df`` as a bucketed table in the shared folder; its name is gone from the catalog at the end, its files stay.

    What was built from the table inside still reads it afterwards.
    """
    spark = df.sparkSession
    name = f"laid_out_{uuid.uuid4().hex}"
    write_bucketed(df, name, keys, buckets, path=table_path(spark, "laid-out"))
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def write_labels(labels: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Community labels as JSON records, one per vertex."""
    return write_json(labels, path, mode)
