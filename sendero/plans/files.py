"""Sources and sinks. Each query writes a whole table in some format and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sendero.plans.registry import query, table
from sendero.session import table_path
from sendero.sources import json_arrays, readers, writers


@query("SELECT c_custkey, c_mktsegment FROM customer")
def scan_columns(spark, sf_dir):
    return readers.scan_parquet(spark, f"{sf_dir}/custome*.parquet").select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = writers.write_csv(orders, table_path(spark, "csv"))
    return readers.read_csv(spark, path, schema=orders.schema)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def csv_text_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return readers.read_csv(spark, writers.write_csv(orders, table_path(spark, "csv")))


@query('SELECT CAST(p_partkey AS VARCHAR) AS "_c0", p_name AS "_c1" FROM part')
def csv_without_header(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    path = writers.write_csv(part, table_path(spark, "csv"), header=False)
    return readers.read_csv(spark, path, header=False)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_inferred(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = writers.write_csv(customers, table_path(spark, "csv"), sep=";")
    found = readers.read_csv(spark, path, sep=";", infer=True)
    return found.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def json_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return readers.read_json(spark, writers.write_json(orders, table_path(spark, "json")), schema=orders.schema)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def json_array_scan(spark, sf_dir):
    """Arrays of orders, a file per writing task, read back in ranges."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    return json_arrays.read_json_arrays(spark, json_arrays.write_json_arrays(orders, table_path(spark, "arrays")), orders.schema)


@query("SELECT doc_id, text FROM documents")
def json_array_documents(spark, sf_dir):
    """Texts with quotes, braces and line breaks, read in ranges of an array."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = json_arrays.write_json_arrays(documents, table_path(spark, "arrays"))
    return json_arrays.read_json_arrays(spark, path, "doc_id bigint, text string")


@query("""SELECT source, line, count(*) AS n FROM (
          SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1, 2""")
def text_lines(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("source", "text")
    path = writers.write_lines(documents, table_path(spark, "lines"), "source")
    return readers.read_lines(spark, path).groupBy("source", "line").agg(F.count("*").alias("n"))


@query("SELECT CAST(20 AS BIGINT) AS n, CAST(20 AS BIGINT) AS known")
def preview_lines(spark, sf_dir):
    """How many lines a preview shows, and how many of them are lines of the table."""
    documents = table(spark, sf_dir, "documents").select("text")
    path = writers.write_lines(documents, table_path(spark, "lines"))
    shown = readers.preview_lines(spark, path, 20).withColumn("place", F.monotonically_increasing_id())
    lines = documents.select(F.explode(F.split("text", "\n")).alias("line")).distinct().withColumn("seen", F.lit(1))
    return shown.join(lines, "line", "left").agg(F.count("*").alias("n"), F.count("seen").alias("known"))


@query("SELECT count(*) AS n, CAST(1 AS BIGINT) AS per_row FROM lineitem")
def file_manifest(spark, sf_dir):
    """All rows of all files, and whether each file is listed once."""
    files = readers.file_manifest(table(spark, sf_dir, "lineitem"))
    return files.agg(F.sum("n").alias("n"), (F.count("*") / F.count_distinct("file_name")).cast("bigint").alias("per_row"))


@query("SELECT * FROM lineitem")
def partitioned_roundtrip(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    path = writers.write_partitioned(lines, table_path(spark, "lineitem"), "l_returnflag")
    return readers.scan_parquet(spark, path).select(lines.columns)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R'")
def partition_pruned(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    path = writers.write_partitioned(lines, table_path(spark, "lineitem"), "l_returnflag")
    return readers.scan_parquet(spark, path).where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def table_roundtrip(spark, sf_dir):
    name = f"sendero_{uuid.uuid4().hex}"
    writers.write_table(table(spark, sf_dir, "supplier"), name, path=table_path(spark, "supplier"))
    return spark.table(name)


@query("SELECT p_partkey AS v, p_brand AS label FROM part")
def labels_json(spark, sf_dir):
    labels = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("v"), F.col("p_brand").alias("label"))
    return readers.read_json(spark, writers.write_labels(labels, table_path(spark, "labels")), schema=labels.schema)


@query("""SELECT DISTINCT least(l_partkey, l_suppkey) AS src, greatest(l_partkey, l_suppkey) AS dst FROM lineitem""")
def edge_list_csv(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    return readers.load_edges(spark, writers.write_csv(pairs, table_path(spark, "edges")), node_type="bigint")


@query("""SELECT DISTINCT least('part/' || l_partkey, 'supplier/' || l_suppkey) AS src,
          greatest('part/' || l_partkey, 'supplier/' || l_suppkey) AS dst FROM lineitem""")
def edge_list_text(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("part/"), F.col("l_partkey").cast("string")).alias("a"),
        F.concat(F.lit("supplier/"), F.col("l_suppkey").cast("string")).alias("b"))
    return readers.load_edges(spark, writers.write_csv(pairs, table_path(spark, "edges")))


@query("SELECT doc_id, text FROM documents")
def csv_documents(spark, sf_dir):
    """Texts with line breaks, quotes and blanks at their ends come back as they were."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = writers.write_csv(documents, table_path(spark, "csv"), null="\\N")
    return readers.read_csv(spark, path, schema="doc_id bigint, text string", multiline=True, null="\\N")


@query("""SELECT count(*) FILTER (WHERE p_size <= 25) AS good, count(*) FILTER (WHERE p_size > 25) AS rejected,
          CAST(sum(p_size) FILTER (WHERE p_size <= 25) AS BIGINT) AS total FROM part""")
def csv_rejects(spark, sf_dir):
    """Large sizes are written as words; those lines are counted, not lost."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(
        F.col("p_size") > 25, F.col("p_brand")).otherwise(F.col("p_size").cast("string")).alias("size"))
    path = writers.write_csv(part, table_path(spark, "csv"))
    rows = readers.read_csv(spark, path, schema="p_partkey bigint, size int", rejects="line")
    return rows.agg(F.count(F.when(F.col("line").isNull(), F.col("p_partkey"))).alias("good"),
                    F.count("line").alias("rejected"), F.sum("size").alias("total"))


@query("SELECT count(*) AS n, count(*) AS ids FROM orders")
def row_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return readers.add_row_id(orders).agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("ids"))


NORMAL = """round(sqrt(-2 * ln((('0x' || substr(md5('1:{0}:' || o_orderkey), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE))
    * cos(2 * pi() * ((('0x' || substr(md5('1:{0}:' || o_orderkey), 14, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)), 9) AS {0}"""


@query(f"SELECT o_orderkey, {', '.join(NORMAL.format(c) for c in 'ABCD')} FROM orders")
def normal_columns(spark, sf_dir):
    drawn = readers.random_normals(table(spark, sf_dir, "orders").select("o_orderkey"), list("ABCD"), seed=1, key=["o_orderkey"])
    return drawn.select("o_orderkey", *[F.round(c, 9).alias(c) for c in "ABCD"])


@query("""SELECT o_custkey, count(*) AS lines, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS orders, round(sum(l_quantity), 2) AS quantity
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def bucketed_join(spark, sf_dir):
    """Lines and orders laid out by order, merged where they lie and summed up per order before anything moves."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    buckets = writers.buckets_for(lines.count())
    with writers.laid_out(lines, ["orderkey"], buckets) as lines, writers.laid_out(orders, ["orderkey"], buckets) as orders:
        per_order = (lines.join(orders.hint("merge"), "orderkey").groupBy("orderkey", "o_custkey")
                     .agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q")))
        return per_order.groupBy("o_custkey").agg(F.sum("n").alias("lines"), F.count("*").alias("orders"),
                                                  F.round(F.sum("q"), 2).alias("quantity"))
