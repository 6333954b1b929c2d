"""Tables from files, rows and pandas. Schemas are given; inference is a choice."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sendero.operators.communities import undirected_edges

Schema = str | StructType | list[str]


def from_rows(spark: SparkSession, rows: list, schema: Schema | None = None, partitions: int | None = None) -> DataFrame:
    """Rows of the program as a table; ``schema`` is DDL text, a StructType, column names or nothing."""
    df = spark.createDataFrame(rows, schema)
    return df.repartition(partitions) if partitions else df


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: Schema | None = None,
                index_col: str | None = None) -> DataFrame:
    """A pandas frame as a table. NaN becomes NULL; ``index_col`` keeps the index as a column."""
    if index_col:
        frame = frame.rename_axis(index_col).reset_index()
    df = spark.createDataFrame(frame, schema)
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df


def to_pandas_api(df: DataFrame, index_col: str):
    """The table as a pandas-on-Spark frame, still distributed, indexed by one of its columns."""
    return df.pandas_api(index_col=index_col)


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None, header: bool = True,
             sep: str = ",", infer: bool = False, multiline: bool = False, null: str = "",
             rejects: str | None = None) -> DataFrame:
    """CSV with doubled quotes as the escape. Without schema and inference all columns are text.

    A line that does not fit the schema is an error. With ``rejects`` it is kept instead, its text in that column and
    the unreadable values NULL; ``rejects`` needs a schema. ``multiline`` reads quoted line breaks, one task per file.
    ``null`` is how NULL is written; with the default an empty text comes back as NULL.
    """
    reader = spark.read.options(header=header, sep=sep, quote='"', escape='"', multiLine=multiline, nullValue=null)
    return _reader(reader, schema, rejects, inferSchema=infer).csv(path)


def _reader(reader, schema: str | StructType | None, rejects: str | None, **otherwise):
    if rejects is None:
        reader = reader.option("mode", "FAILFAST")
        return reader.schema(schema) if schema is not None else reader.options(**otherwise)
    if schema is None:
        raise ValueError("kept rejects need a schema")
    known = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    return reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=rejects, columnPruning=False).schema(
        known.add(rejects, "string"))


def read_json(spark: SparkSession, path: str, schema: str | StructType | None = None, multiline: bool = False,
              rejects: str | None = None) -> DataFrame:
    """One record per line, or with ``multiline`` one document or array per file; ``rejects`` as in ``read_csv``."""
    return _reader(spark.read.option("multiLine", multiline), schema, rejects).json(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Avro files; needs the spark-avro package on the class path."""
    return spark.read.format("avro").load(path)


def scan_parquet(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Parquet by path or glob."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line`` per text line of the files under a path or glob, beside any partition columns."""
    return spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")


def preview_lines(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """The first lines; reading stops once they are there."""
    return read_lines(spark, path).limit(n)


def file_manifest(df: DataFrame) -> DataFrame:
    """``(file_name, file_size, n)`` of the files behind a scanned table."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("file_size")).agg(
        F.count("*").alias("n"))


def load_edges(spark: SparkSession, path: str, node_type: str = "string") -> DataFrame:
    """Edge-list CSV with a header line and two node columns, as canonical undirected edges.

    A node that ``node_type`` cannot hold is an error. A line without one of its nodes is no edge.
    """
    pairs = read_csv(spark, path, schema=f"a {node_type}, b {node_type}")
    return undirected_edges(pairs, "a", "b")


def random_normals(df: DataFrame, names: list[str], seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """Add standard normal columns.

    With ``key`` a value depends on the seed, its column's name and the row's key alone: the same in any partitioning, in
    a task that runs again and in any engine. Rows with equal keys draw equal values. Without a key Spark draws them by place.
    """
    if key is None:
        return df.withColumns({name: F.randn(seed + i) for i, name in enumerate(names)})

    def uniform(name: str, first: int) -> Column:
        """52 bits of the digest, strictly between 0 and 1."""
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(name), *[F.col(k).cast("string") for k in key]))
        return (F.conv(F.substring(digest, first, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(2.0**52)
    return df.withColumns({name: F.sqrt(-2 * F.log(uniform(name, 1))) * F.cos(2 * F.pi() * uniform(name, 14)) for name in names})


def add_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique increasing ids, not consecutive and not stable across runs: never a join key."""
    return df.withColumn(name, F.monotonically_increasing_id())
