"""Projections, filters, joins, aggregates, orders and dates over the business tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.functions.dates import calendar, date_time_text, parse_date
from sendero.functions.hashing import short_hash
from sendero.operators.ordering import (merge_ordered as merge_ordered_tables, merge_ordered_positions, quantiles,
                                        with_position)
from sendero.operators.summaries import (assign_between, center, column_means, correlations, describe,
                                         describe_text, group_means, group_sums, histogram,
                                         numeric_columns, reindex)
from sendero.plans.registry import query, table


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def select_cols(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey, o_totalprice * 2 AS price_x2 FROM orders")
def with_column(spark, sf_dir):
    return (table(spark, sf_dir, "orders").withColumn("price_x2", F.col("o_totalprice") * 2)
            .select("o_orderkey", "price_x2"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_cols(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_nationkey", "c_acctbal")


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def rename_cols(spark, sf_dir):
    return table(spark, sf_dir, "supplier").withColumnsRenamed(
        {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"})


@query("SELECT p_partkey, p_size + 1 AS size_plus_one FROM part")
def select_expr(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "p_size + 1 AS size_plus_one")


@query("SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric_projection(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(numeric_columns(part))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 30000")
def filter_cmp(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").where(F.col("o_totalprice") >= 30000)


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 30000 AND o_orderpriority = '5-LOW'")
def filter_and(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .where((F.col("o_totalprice") > 30000) & (F.col("o_orderpriority") == "5-LOW")).select("o_orderkey"))


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' OR o_orderpriority = '3-MEDIUM'")
def filter_or(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .where((F.col("o_orderpriority") == "5-LOW") | (F.col("o_orderpriority") == "3-MEDIUM"))
            .select("o_orderkey"))


@query("""SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS st, nullif(o_orderpriority, '5-LOW') AS pr
          FROM orders) WHERE st IS NOT NULL AND pr IS NOT NULL""")
def filter_not_null(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS st", "nullif(o_orderpriority, '5-LOW') AS pr")
            .where("st is not null and pr is not null"))


@query("SELECT count(*) > 0 AS non_empty FROM orders")
def non_empty(spark, sf_dir):
    return table(spark, sf_dir, "orders").select((F.count("*") > 0).alias("non_empty"))


@query("SELECT count(*) AS n FROM orders")
def sql_count(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("sendero_orders")
    return spark.sql("SELECT count(*) AS n FROM sendero_orders")


@query("""SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
          THEN 1.0::DOUBLE END AS e FROM orders""")
def range_assign(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    first, last = F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")
    return assign_between(orders, "d", first, last, "e", 1.0).select("o_orderkey", "e")


@query("""SELECT d, n, NULL::DOUBLE AS e
          FROM (SELECT unnest(generate_series(min(l_shipdate::DATE), max(l_shipdate::DATE), INTERVAL 1 DAY))::DATE AS d
                FROM lineitem)
          LEFT JOIN (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1) USING (d)""")
def reindex_dates(spark, sf_dir):
    daily = (table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("d"))
             .agg(F.count("*").alias("n")))
    days = calendar(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return reindex(daily, "d", days, F.lit(None).cast("double").alias("e"))


@query("""SELECT unnest(generate_series(min(o_orderdate::DATE), max(o_orderdate::DATE), INTERVAL 1 DAY))::DATE AS d
          FROM orders""")
def generate_dates(spark, sf_dir):
    return calendar(table(spark, sf_dir, "orders"), "o_orderdate")


@query("""SELECT k, balance, n FROM (SELECT c_custkey AS k, c_acctbal AS balance FROM customer WHERE c_acctbal < 0)
          FULL JOIN (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_totalprice > 400000 GROUP BY 1) USING (k)""")
def join_full_outer(spark, sf_dir):
    indebted = (table(spark, sf_dir, "customer").where("c_acctbal < 0")
                .select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("balance")))
    large = (table(spark, sf_dir, "orders").where("o_totalprice > 400000")
             .groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n")))
    return indebted.join(large, "k", "outer")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return orders.join(customers, "custkey").select("o_orderkey", "c_name")


MERGED = """SELECT user_id, d, v, n
    FROM (SELECT user_id, CAST(ts AS DATE) AS d, round(sum(value), 4) AS v FROM events
          WHERE event_type = 'purchase' GROUP BY 1, 2)
    FULL JOIN (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events
               WHERE event_type = 'error' GROUP BY 1, 2) USING (user_id, d)"""


def daily_purchases_and_errors(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("d", F.col("ts").cast("date"))
    purchases = (events.where("event_type = 'purchase'").groupBy("user_id", "d")
                 .agg(F.round(F.sum("value"), 4).alias("v")))
    errors = events.where("event_type = 'error'").groupBy("user_id", "d").agg(F.count("*").alias("n"))
    return purchases, errors


@query(MERGED)
def merge_ordered(spark, sf_dir):
    purchases, errors = daily_purchases_and_errors(spark, sf_dir)
    return merge_ordered_tables(purchases, errors, ["user_id", "d"])


# A quarter of all events belong to user -1, and some to nobody.
SKEWED = """CASE WHEN md5(event_id::VARCHAR) < '4' THEN -1 WHEN md5(event_id::VARCHAR) >= 'f' THEN NULL ELSE user_id END"""


@query(f"""WITH e AS (SELECT *, {SKEWED} AS who FROM events),
    a AS (SELECT who, event_id AS bought, value FROM e WHERE event_type = 'purchase'),
    b AS (SELECT who, count(*) AS errors FROM e WHERE event_type = 'error' GROUP BY 1)
    SELECT coalesce(a.who, b.who) AS who, bought, value, errors,
           row_number() OVER (ORDER BY coalesce(a.who, b.who) NULLS LAST, bought NULLS LAST) AS position
    FROM a FULL JOIN b ON a.who IS NOT DISTINCT FROM b.who""")
def merge_ordered_position(spark, sf_dir):
    """Purchases beside their user's number of errors, in the order of the user and then the purchase."""
    digest = F.md5(F.col("event_id").cast("string"))
    who = F.when(digest < "4", -1).when(digest >= "f", None).otherwise(F.col("user_id")).cast("bigint")
    events = table(spark, sf_dir, "events").withColumn("who", who)
    bought = events.where("event_type = 'purchase'").select("who", F.col("event_id").alias("bought"), "value")
    errors = events.where("event_type = 'error'").groupBy("who").agg(F.count("*").alias("errors"))
    return merge_ordered_positions(bought, errors, ["who"], ["bought"])


# Both sides have a NULL key and keys that the other lacks.
MERGED_NULLS = """WITH a AS (SELECT nullif(o_orderpriority, '1-URGENT') AS k, round(sum(o_totalprice), 2) AS v FROM orders
        WHERE o_orderpriority <> '2-HIGH' GROUP BY 1),
    b AS (SELECT nullif(o_orderpriority, '5-LOW') AS k, count(*) AS n FROM orders
          WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1)
    SELECT a.k, v, n FROM a LEFT JOIN b ON a.k IS NOT DISTINCT FROM b.k
    UNION ALL SELECT k, NULL, n FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k IS NOT DISTINCT FROM b.k)"""


def totals_with_null_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    totals = (orders.where("o_orderpriority <> '2-HIGH'").groupBy(F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("k"))
              .agg(F.round(F.sum("o_totalprice"), 2).alias("v")))
    counts = (orders.where("o_orderpriority <> '3-MEDIUM'").groupBy(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("k"))
              .agg(F.count("*").alias("n")))
    return totals, counts


@query(MERGED_NULLS)
def merge_null_keys(spark, sf_dir):
    return merge_ordered_tables(*totals_with_null_keys(spark, sf_dir), ["k"])


def quantity_with_nan(spark, sf_dir):
    """Quantities of 1 are NaN, of 2 NULL."""
    quantity = F.when(F.col("l_quantity") == 1, float("nan")).when(F.col("l_quantity") != 2, F.col("l_quantity").cast("double"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", quantity.alias("q"))


KNOWN_QUANTITY = "CASE WHEN l_quantity > 2 THEN l_quantity::DOUBLE END"


@query(f"SELECT l_returnflag, sum({KNOWN_QUANTITY}) AS sum_q FROM lineitem GROUP BY 1")
def group_sum_nan(spark, sf_dir):
    return group_sums(quantity_with_nan(spark, sf_dir).select("l_returnflag", "q"), "l_returnflag")


@query(f"""SELECT l_orderkey, l_linenumber, round({KNOWN_QUANTITY} - avg({KNOWN_QUANTITY}) OVER (PARTITION BY l_returnflag), 4)
           AS centered FROM lineitem WHERE l_quantity > 2""")
def group_center_nan(spark, sf_dir):
    centered = center(quantity_with_nan(spark, sf_dir), "l_returnflag", "q")
    return centered.where("q > 2 and not isnan(q)").select(
        "l_orderkey", "l_linenumber", F.round("centered", 4).alias("centered"))


@query(f"""WITH q AS (SELECT {KNOWN_QUANTITY} AS x FROM lineitem WHERE l_quantity > 2),
    r AS (SELECT min(x) AS lo, max(x) AS hi FROM q)
    SELECT CAST(least(floor((x - lo) / (hi - lo) * 7), 6) AS INTEGER) AS bin, count(*) AS n FROM q, r GROUP BY 1""")
def histogram_nan(spark, sf_dir):
    return histogram(quantity_with_nan(spark, sf_dir), "q", 7)


@query("""SELECT o_orderpriority, round(avg(o_totalprice), 4) AS avg_price FROM orders
          WHERE o_totalprice >= 30000 GROUP BY 1""")
def group_avg(spark, sf_dir):
    return (table(spark, sf_dir, "orders").where("o_totalprice >= 30000")
            .groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 4).alias("avg_price")))


@query("""SELECT p_brand, round(avg(p_partkey), 4) AS avg_p_partkey, round(avg(p_size), 4) AS avg_p_size,
          round(avg(p_retailprice), 4) AS avg_p_retailprice FROM part GROUP BY 1""")
def group_avg_all(spark, sf_dir):
    means = group_means(table(spark, sf_dir, "part"), "p_brand")
    return means.select("p_brand", *[F.round(c, 4).alias(c) for c in means.columns if c != "p_brand"])


@query("""SELECT 'l_quantity' AS col, count(l_quantity) AS n, round(avg(l_quantity), 4) AS mean,
            round(stddev_samp(l_quantity), 4) AS sd, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem
          UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 4),
            round(stddev_samp(l_extendedprice), 4), min(l_extendedprice), max(l_extendedprice) FROM lineitem
          UNION ALL SELECT 'l_linenumber', count(l_linenumber), round(avg(l_linenumber), 4),
            round(stddev_samp(l_linenumber), 4), min(l_linenumber)::DOUBLE, max(l_linenumber)::DOUBLE FROM lineitem""")
def describe_long(spark, sf_dir):
    rows = describe(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])
    return rows.select("col", "n", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), "lo", "hi")


@query("""SELECT 'c_name' AS col, count(c_name) AS n, min(c_name) AS lo, max(c_name) AS hi FROM customer
          UNION ALL SELECT 'c_mktsegment', count(c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM customer""")
def describe_strings(spark, sf_dir):
    return describe_text(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment"])


@query("""SELECT col, p, round(value, 6) AS value FROM (
            SELECT 'l_quantity' AS col, unnest([0.25, 0.5, 0.75])::DOUBLE AS p,
                   unnest(quantile_cont(l_quantity, [0.25, 0.5, 0.75])) AS value FROM lineitem
            UNION ALL SELECT 'l_extendedprice', unnest([0.25, 0.5, 0.75])::DOUBLE,
                   unnest(quantile_cont(l_extendedprice, [0.25, 0.5, 0.75])) FROM lineitem)""")
def describe_quantiles(spark, sf_dir):
    rows = quantiles(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.75])
    return rows.select("col", "p", F.round("value", 6).alias("value"))


@query("""SELECT round(avg(l_quantity), 4) AS quantity, round(avg(l_discount), 4) AS discount,
          round(avg(nullif(l_tax, 0)), 4) AS tax FROM lineitem""")
def mean_of_columns(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity AS quantity", "l_discount AS discount", "nullif(l_tax, 0) AS tax")
    means = column_means(lines, lines.columns)
    return means.select(*[F.round(c, 4).alias(c) for c in means.columns])


@query("""SELECT l_returnflag, round(sum(l_quantity), 2) AS quantity,
          CAST(sum(l_linenumber) AS BIGINT) AS linenumber FROM lineitem GROUP BY 1""")
def group_sum(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_linenumber")
    return group_sums(lines, "l_returnflag").select(
        "l_returnflag", F.round("sum_l_quantity", 2).alias("quantity"), F.col("sum_l_linenumber").alias("linenumber"))


@query("SELECT DISTINCT l_returnflag FROM lineitem")
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()


@query("SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def count_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count_distinct("l_partkey").alias("n"))


CENTERED = """SELECT p_partkey, p_brand, round(p_retailprice - avg(p_retailprice) OVER (PARTITION BY p_brand), 4) AS centered
    FROM part"""


@query(CENTERED)
def group_center(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    return center(part, "p_brand", "p_retailprice").select(
        "p_partkey", "p_brand", F.round("centered", 4).alias("centered"))


@query("""SELECT CAST(least(floor((l_quantity - lo) / (hi - lo) * 90), 89) AS INT) AS bin, count(*) AS n
          FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem) GROUP BY 1""")
def histogram_bins(spark, sf_dir):
    return histogram(table(spark, sf_dir, "lineitem"), "l_quantity", 90)


@query("""SELECT 'l_quantity' AS col, round(corr(l_extendedprice, l_quantity), 6) AS r FROM lineitem
          UNION ALL SELECT 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem
          UNION ALL SELECT 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem""")
def corr_to_target(spark, sf_dir):
    rows = correlations(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return rows.select("col", F.round("r", 6).alias("r"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rn FROM orders")
def sort_asc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return with_position(orders, F.asc("o_totalprice"), F.asc("o_orderkey")).select("o_orderkey", "rn")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders")
def sort_desc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return with_position(orders, F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_orderkey", "rn")


@query("""SELECT p_partkey, row_number() OVER (ORDER BY nullif(p_size, 10) ASC NULLS LAST, p_partkey) AS rn
          FROM part""")
def sort_values(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey", "nullif(p_size, 10) AS size")
    return with_position(part, F.asc_nulls_last("size"), F.asc("p_partkey")).select("p_partkey", "rn")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def first_n(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(5)


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
          strftime(strptime(strftime(l_shipdate, '%m/%d/%Y'), '%m/%d/%Y'), '%Y-%m-%d %H:%M:%S') AS ship_date
          FROM lineitem""")
def normalize_date(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format(F.col("l_shipdate").cast("date"), "MM/dd/yyyy").alias("t"))
    return raw.select("l_orderkey", "l_linenumber", "l_partkey", date_time_text("t").alias("ship_date"))


@query("""SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS DATE) AS d FROM orders""")
def to_date_col(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(F.col("o_orderdate").cast("date"), "MM/dd/yyyy").alias("t"))
    return raw.select("o_orderkey", parse_date("t").alias("d"))


@query("SELECT c_name, substr(sha1(c_name), 1, 8) AS id FROM customer")
def node_hash(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_name", short_hash("c_name", 8).alias("id"))


@query("""SELECT * FROM (SELECT p_partkey, nullif(p_size, 10) AS sz, nullif(p_type, 'PROMO') AS ty FROM part)
          WHERE sz IS NOT NULL AND ty IS NOT NULL""")
def dropna_any(spark, sf_dir):
    return (table(spark, sf_dir, "part")
            .selectExpr("p_partkey", "nullif(p_size, 10) AS sz", "nullif(p_type, 'PROMO') AS ty").dropna("any"))


@query("SELECT p_partkey, coalesce(nullif(p_size, 10), 5) AS sz FROM part")
def fillna_const(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr("p_partkey", "nullif(p_size, 10) AS sz").fillna(5)
