"""Python functions over Arrow batches, each with a built-in form to compare with."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.functions.vectorized import (center_in_pandas, keep_equal, merge_ordered_in_pandas, plus_one,
                                          register_sql_functions)
from sendero.plans.registry import query, table
from sendero.plans.relational import (CENTERED, MERGED, MERGED_NULLS, daily_purchases_and_errors,
                                      totals_with_null_keys)


@query("SELECT o_orderkey, o_custkey + 1 AS plus_one FROM orders")
def udf_plus_one(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", plus_one("o_custkey").alias("plus_one"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey + 9007199254740993 + 1 END AS plus_one
          FROM orders""")
def udf_plus_one_nulls(spark, sf_dir):
    """Integers beyond 2**53 beside NULLs in one batch."""
    large = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") + F.lit(9007199254740993))
    return table(spark, sf_dir, "orders").select("o_orderkey", plus_one(large).alias("plus_one"))


@query("SELECT p_partkey, p_size + 1 AS plus_one FROM part")
def udf_sql(spark, sf_dir):
    register_sql_functions(spark)
    table(spark, sf_dir, "part").createOrReplaceTempView("sendero_part")
    return spark.sql("SELECT p_partkey, add_one(p_size) AS plus_one FROM sendero_part")


@query("SELECT p_partkey, p_size FROM part WHERE p_size = 10")
def udf_map_batches(spark, sf_dir):
    return keep_equal(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", 10)


@query(CENTERED)
def udf_group_map(spark, sf_dir):
    part = center_in_pandas(table(spark, sf_dir, "part"), "p_partkey", "p_brand", "p_retailprice")
    return part.withColumn("centered", F.round("centered", 4))


@query(MERGED)
def udf_cogroup(spark, sf_dir):
    purchases, errors = daily_purchases_and_errors(spark, sf_dir)
    return merge_ordered_in_pandas(purchases, errors, ["user_id", "d"], "user_id bigint, d date, v double, n bigint")


@query(MERGED_NULLS)
def udf_cogroup_null_keys(spark, sf_dir):
    purchases, errors = totals_with_null_keys(spark, sf_dir)
    return merge_ordered_in_pandas(purchases, errors, ["k"], "k string, v double, n bigint")
