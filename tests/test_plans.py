"""The plans: what reaches the scan, what stays in the JVM, and how a hot key is split."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sendero.functions import wordcount
from sendero.operators.summaries import center
from sendero.plans.graphs import sales
from sendero.sources import writers


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def plan_after_run(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def third_in_one_key(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "t")
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_spark_splits_a_hot_group_of_with_group_stats(spark, third_in_one_key):
    with settings(spark, **SMALL_PARTITIONS):
        plan = plan_after_run(center(third_in_one_key, "k", "x"))
    assert "SortMergeJoin(skew=true)" in plan


def test_rows_of_few_groups_stay_where_they_are(spark):
    rows = spark.range(0, 3000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64"}):
        centered = center(rows, "k", "x")
        assert "hashpartitioning" not in plan_after_run(centered)
    assert centered.agg(F.max("centered"), F.count("*")).first() == (1498.5, 3000)


def test_spark_splits_a_hot_order(spark, third_in_one_key, tmp_path):
    third_in_one_key.select(F.col("k").alias("l_orderkey"), F.col("x").alias("l_partkey"), F.col("x").alias("l_suppkey")
                            ).write.parquet(f"{tmp_path}/lineitem.parquet")
    third_in_one_key.select(F.col("k").alias("o_orderkey"), (F.col("k") + 1).alias("o_custkey")).distinct(
        ).write.parquet(f"{tmp_path}/orders.parquet")
    with settings(spark, **SMALL_PARTITIONS):
        plan = plan_after_run(sales(spark, str(tmp_path)))
    assert "SortMergeJoin(skew=true)" in plan


def test_laid_out_tables_meet_where_they_lie(spark):
    rows = spark.range(0, 20000, 1, 8).select((F.col("id") % 4000).alias("k"), F.col("id").alias("x"))
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        with writers.laid_out(rows, ["k"], 8) as left, writers.laid_out(rows.groupBy("k").agg(F.max("x").alias("y")), ["k"], 8) as right:
            names = {t.name for t in spark.catalog.listTables()}
            joined = left.join(right, "k").groupBy("k").agg(F.sum("y").alias("y"))
        plan = plan_after_run(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert joined.count() == 4000 and joined.agg(F.max("y")).first()[0] == 19999 * 5
    assert not names & {t.name for t in spark.catalog.listTables()}
    assert writers.buckets_for(10) == 8 and writers.buckets_for(10**11) == 25_000


def test_sketches_are_all_that_moves(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sketches = wordcount.merged_sketches(wordcount.vocabulary_sketches(documents, "text", "source"))
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    for exchange in plan.split("Exchange")[1:]:
        assert "partial_hll" in exchange.split("\n")[1]


@pytest.mark.parametrize("name,columns,pushed", [
    ("filter_cmp", "o_orderkey:bigint,o_totalprice:double", "GreaterThanOrEqual(o_totalprice,30000.0)"),
    ("filter_and", "o_orderkey:bigint,o_totalprice:double,o_orderpriority:string", "EqualTo(o_orderpriority,5-LOW)"),
    ("filter_or", "o_orderkey:bigint,o_orderpriority:string", "Or(EqualTo(o_orderpriority,5-LOW)"),
    ("group_avg", "o_totalprice:double,o_orderpriority:string", "IsNotNull(o_totalprice)"),
    ("word_count", "text:string", ""),
    ("line_search_counts", "text:string", ""),
    ("udf_map_batches", "p_partkey:bigint,p_size:int", ""),
    ("row_ids", "", ""),
])
def test_scans_read_what_is_used(spark, sf_dir, name, columns, pushed):
    plan = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<{columns}>" in plan and pushed in plan
