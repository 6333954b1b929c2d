"""Graph queries over the trade network: customer, part and supplier of every line item, linked in a ring."""

from __future__ import annotations

from pyspark.sql import functions as F

from sendero.operators.communities import (edge_weights, label_propagation, modularity, multigraph_arcs,
                                           multigraph_labels, propagate, symmetrize, undirected_edges)
from sendero.operators.links import (hashed_edges, hashed_vertices, id_collisions, in_degrees, named_links, page_rank,
                                     vertex_names)
from sendero.functions.hashing import short_hash
from sendero.plans.registry import query, table
from sendero.operators.skew import hot_keys, repeat_rows, slice_rows
from sendero.session import ROWS_PER_PART, materialize, release

# T: directed links by name, repeats kept. E: undirected edges by number. U: both directions.
T = """WITH RECURSIVE s AS (SELECT 'customer/' || o_custkey AS c, 'part/' || l_partkey AS p, 'supplier/' || l_suppkey AS s
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    t AS (SELECT s AS src, p AS dst FROM s UNION ALL SELECT p, c FROM s UNION ALL SELECT c, s FROM s) """
E = """WITH RECURSIVE s AS (SELECT o_custkey * 3 AS c, l_partkey * 3 + 1 AS p, l_suppkey * 3 + 2 AS s
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    r AS (SELECT s AS a, p AS b FROM s UNION ALL SELECT p, c FROM s UNION ALL SELECT c, s FROM s),
    e AS (SELECT DISTINCT least(a, b) AS src, greatest(a, b) AS dst FROM r),
    u AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e) """
C = E + """, d AS (SELECT src AS v, count(*) AS deg FROM u GROUP BY 1),
    c AS (SELECT e.src, e.dst, count(y.dst) AS c FROM e LEFT JOIN u AS x ON x.src = e.src
          LEFT JOIN u AS y ON y.src = x.dst AND y.dst = e.dst GROUP BY 1, 2) """
M = E + ", m AS (SELECT a AS src, b AS dst, count(*) AS w FROM (SELECT a, b FROM r UNION ALL SELECT b, a FROM r) GROUP BY 1, 2) "


def label_rounds(rounds: int) -> str:
    return M + f""", l AS (SELECT 0 AS i, src AS v, src AS label FROM (SELECT DISTINCT src FROM m)
        UNION ALL SELECT i, v, label FROM (
            SELECT l.i + 1 AS i, m.dst AS v, l.label,
                   row_number() OVER (PARTITION BY m.dst ORDER BY sum(m.w) DESC, l.label) AS k
            FROM l JOIN m ON l.v = m.src WHERE l.i < {rounds} GROUP BY l.i, m.dst, l.label) WHERE k = 1),
        fin AS (SELECT v, label FROM l WHERE i = {rounds}) """


BUCKETED = M + """, l AS (SELECT 0 AS i, src AS v, src AS label FROM (SELECT DISTINCT src FROM m)
        UNION ALL SELECT i + 1 AS i, v, label FROM (
            SELECT l.i, m.dst AS v, l.label, row_number() OVER (PARTITION BY m.dst ORDER BY sum(m.w) DESC,
                       md5('42:' || (l.i // 3 + 1) || ':' || m.dst || ':' || l.label), l.label) AS k
            FROM l JOIN m ON l.v = m.src
            WHERE l.i < 6 AND ('0x' || substr(md5('42:' || m.dst), 1, 8))::BIGINT % 3 = l.i % 3
            GROUP BY l.i, m.dst, l.label
            UNION ALL SELECT i, v, label, 1 FROM l
            WHERE i < 6 AND ('0x' || substr(md5('42:' || v), 1, 8))::BIGINT % 3 <> i % 3) WHERE k = 1)
    SELECT v, label FROM l WHERE i = 6"""

# p: vertices by falling (degree, digest, number), k: colours so far, q: classes of those done, z: overlap votes, l: labels after i sweeps.
SWEPT = C + """, p AS (SELECT v, row_number() OVER (ORDER BY deg DESC, md5('42:' || v) DESC, v DESC) AS pos FROM d),
    k AS (SELECT 0 AS i, v, pos, NULL::BIGINT AS colour FROM p UNION ALL
        SELECT i + 1 AS i, v, pos, CASE WHEN colour IS NOT NULL OR pos = first THEN coalesce(colour, tried) END AS colour FROM (
            SELECT a.i, a.v, a.pos, a.colour, a.tried, min(CASE WHEN b.tried = a.tried THEN b.pos ELSE a.pos END) AS first FROM ({tries}) AS a
            JOIN (SELECT src, dst FROM u UNION ALL SELECT v, v FROM p) AS u2 ON u2.src = a.v JOIN ({tries}) AS b ON b.v = u2.dst
            GROUP BY ALL) WHERE i < 1000 AND EXISTS (SELECT 1 FROM k AS k2 WHERE k2.colour IS NULL)),
    q AS (SELECT v, least(colour, 15) AS class, max(least(colour, 15)) OVER () + 1 AS classes FROM k WHERE i = (SELECT max(i) FROM k)),
    z AS (SELECT src, dst, c::BIGINT AS w FROM c UNION ALL SELECT dst, src, c::BIGINT FROM c WHERE src <> dst),
    l AS (SELECT 0::BIGINT AS i, v, v AS label, -1::BIGINT AS n FROM q UNION ALL
        SELECT i + 1 AS i, v, label, n FROM (
            SELECT l.i, q.v, l.label, m.n, row_number() OVER (PARTITION BY q.v ORDER BY sum(z.w) DESC,
                       md5('42:' || (l.i // q.classes + 1) || ':' || q.v || ':' || l.label), l.label) AS k
            FROM l JOIN z ON l.v = z.src JOIN q ON q.v = z.dst AND q.class = l.i % q.classes, ({counts}) AS m
            WHERE {going} GROUP BY l.i, q.v, q.classes, l.label, m.n
            UNION ALL SELECT l.i, l.v, l.label, m.n, 1 FROM l JOIN q ON q.v = l.v AND q.class <> l.i % q.classes, ({counts}) AS m
            WHERE {going}) WHERE k = 1)
    SELECT v, label FROM l WHERE i = (SELECT max(i) FROM l)""".format(
        # The smallest colour that no coloured neighbour has; what is coloured tries none.
        tries="""SELECT i, v, pos, colour, CASE WHEN colour IS NULL THEN list_min(list_filter(range(len(taken) + 1), lambda x: NOT list_contains(taken, x))) END AS tried
                 FROM (SELECT k.i, k.v, k.pos, k.colour, coalesce(list(DISTINCT o.colour) FILTER (o.colour IS NOT NULL), []) AS taken
                       FROM k LEFT JOIN u ON u.src = k.v LEFT JOIN k AS o ON o.v = u.dst GROUP BY ALL)""",
        # At the start of a round the number of labels, in between what it was there.
        counts="""SELECT CASE WHEN min(l.i) % (SELECT min(classes) FROM q) = 0 THEN count(DISTINCT l.label) ELSE min(l.n) END AS n FROM l""",
        # A round begins unless the one before left the number of labels as it was.
        going="l.i < 30 * q.classes AND (l.i % q.classes <> 0 OR l.n <> m.n)")

RANKED = T + """, w AS (SELECT src, dst, count(*) AS w FROM t GROUP BY 1, 2),
    o AS (SELECT src, sum(w) AS t FROM w GROUP BY 1),
    vs AS (SELECT src AS v FROM w UNION SELECT dst FROM w),
    r(i, v, x) AS (SELECT 0, v, 1.0::DOUBLE FROM vs UNION ALL
        SELECT i + 1, v, 0.01 + 0.99 * sum(m) FROM (
            SELECT r.i, w.dst AS v, x * w.w / o.t AS m FROM r JOIN w ON r.v = w.src JOIN o ON o.src = w.src WHERE r.i < 20
            UNION ALL SELECT r.i, r.v, 0.0::DOUBLE FROM r WHERE r.i < 20) GROUP BY i, v),
    fin AS (SELECT v AS id, round(x * (SELECT count(*) FROM vs) / (SELECT sum(x) FROM r WHERE i = 20), 6) AS pagerank
            FROM r WHERE i = 20) """


def sales(spark, sf_dir):
    """Customer, part and supplier of every line item."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_partkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    parts = -(-lines.count() // ROWS_PER_PART)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        # More rows than the session's partitions should hold: both sides go to as many as it takes, hot orders in slices.
        hot = hot_keys(lines.groupBy("orderkey").agg(F.count("*").alias("n")), "orderkey")
        lines = slice_rows(lines, "orderkey", "l_partkey", hot).repartition(parts, "orderkey", "slice")
        orders = repeat_rows(orders, "orderkey", hot).repartition(parts, "orderkey", "slice")
        return lines.join(orders.hint("merge"), ["orderkey", "slice"]).select("o_custkey", "l_partkey", "l_suppkey")
    # Orders grow with the data, so they are merged, not broadcast, whatever their size at the moment.
    return lines.join(orders.hint("merge"), "orderkey").select("o_custkey", "l_partkey", "l_suppkey")


def ring(rows, customer, part, supplier):
    """The three links of each sale, supplier to part to customer to supplier."""
    links = F.array(F.struct(supplier.alias("a"), part.alias("b")), F.struct(part.alias("a"), customer.alias("b")),
                    F.struct(customer.alias("a"), supplier.alias("b")))
    return rows.select(F.explode(links).alias("link")).select("link.*")


def trade_links(spark, sf_dir, sold=None):
    """The directed multigraph by name; ``sold`` are the sales, if they are at hand."""
    def name(kind, key):
        return F.concat(F.lit(kind), F.col(key).cast("string"))
    pairs = ring(sales(spark, sf_dir) if sold is None else sold, name("customer/", "o_custkey"), name("part/", "l_partkey"),
                 name("supplier/", "l_suppkey"))
    return named_links(pairs, "a", "b")


def trade_numbers(spark, sf_dir, sold=None):
    """The directed multigraph by number; ``sold`` are the sales, if they are at hand."""
    return ring(sales(spark, sf_dir) if sold is None else sold, F.col("o_custkey") * 3, F.col("l_partkey") * 3 + 1, F.col("l_suppkey") * 3 + 2)


def link_number(spark, sf_dir):
    """Links of all sales, those without an order included."""
    return 3 * table(spark, sf_dir, "lineitem").count()


def trade_edges(spark, sf_dir):
    return undirected_edges(trade_numbers(spark, sf_dir), "a", "b", link_number(spark, sf_dir))


def trade_multigraph(spark, sf_dir):
    return trade_numbers(spark, sf_dir).withColumnsRenamed({"a": "src", "b": "dst"})


def trade_labels(spark, sf_dir, rounds=5):
    sold = materialize(sales(spark, sf_dir), table(spark, sf_dir, "lineitem").count())
    labels = multigraph_labels(trade_numbers(spark, sf_dir, sold).withColumnsRenamed({"a": "src", "b": "dst"}), rounds,
                               number=link_number(spark, sf_dir))
    release(sold)
    return labels


@query(T + "SELECT substr(sha1(name), 1, 8) AS id, name FROM (SELECT src AS name FROM t UNION SELECT dst FROM t)")
def g_vertices(spark, sf_dir):
    return hashed_vertices(trade_links(spark, sf_dir), width=8)


@query(T + "SELECT count(*) AS n FROM (SELECT src FROM t UNION SELECT dst FROM t)")
def g_vertex_count(spark, sf_dir):
    return vertex_names(trade_links(spark, sf_dir)).agg(F.count("*").alias("n"))


@query(T + "SELECT substr(sha1(src), 1, 8) AS src, substr(sha1(dst), 1, 8) AS dst FROM t")
def g_directed_edges(spark, sf_dir):
    return hashed_edges(trade_links(spark, sf_dir), width=8)


@query(T + """SELECT substr(sha1(name), 1, 4) AS id, count(*) AS n FROM (SELECT src AS name FROM t UNION SELECT dst FROM t)
              GROUP BY 1 HAVING count(*) > 1""")
def g_hash_collisions(spark, sf_dir):
    return id_collisions(hashed_vertices(trade_links(spark, sf_dir), width=4))


@query(T + """SELECT substr(sha1(name), 1, 8) AS id, name, in_degree
              FROM (SELECT dst AS name, count(*) AS in_degree FROM t GROUP BY 1) ORDER BY in_degree DESC, name LIMIT 10""")
def g_in_degree_top(spark, sf_dir):
    """By name; the short id, which two names may share, is only shown."""
    top = in_degrees(trade_links(spark, sf_dir)).orderBy(F.desc("in_degree"), "id").limit(10)
    return top.select(short_hash("id", 8).alias("id"), F.col("id").alias("name"), "in_degree")


def trade_ranks(spark, sf_dir):
    sold = materialize(sales(spark, sf_dir), table(spark, sf_dir, "lineitem").count())
    ranks = page_rank(trade_links(spark, sf_dir, sold), number=link_number(spark, sf_dir)).withColumn("pagerank", F.round("pagerank", 6))
    release(sold)
    return ranks


@query(RANKED + "SELECT id, pagerank FROM fin")
def g_pagerank(spark, sf_dir):
    return trade_ranks(spark, sf_dir)


@query(RANKED + "SELECT substr(sha1(id), 1, 8) AS id, id AS name, pagerank FROM fin ORDER BY pagerank DESC, name LIMIT 10")
def g_pagerank_top(spark, sf_dir):
    top = trade_ranks(spark, sf_dir).orderBy(F.desc("pagerank"), "id").limit(10)
    return top.select(short_hash("id", 8).alias("id"), F.col("id").alias("name"), "pagerank")


@query(E + "SELECT src, dst FROM e")
def g_edges(spark, sf_dir):
    return trade_edges(spark, sf_dir)


@query(E + "SELECT src, dst FROM u")
def g_symmetrize(spark, sf_dir):
    return symmetrize(trade_edges(spark, sf_dir))


@query(C + "SELECT src, dst, c::DOUBLE AS w FROM c")
def g_overlap(spark, sf_dir):
    return edge_weights(trade_edges(spark, sf_dir), "overlap")


@query(C + """SELECT c.src, c.dst, round(c::DOUBLE / (a.deg + b.deg - c), 6) AS w
              FROM c JOIN d AS a ON a.v = c.src JOIN d AS b ON b.v = c.dst""")
def g_overlap_norm(spark, sf_dir):
    return edge_weights(trade_edges(spark, sf_dir), "normalized").withColumn("w", F.round("w", 6))


@query(C + """SELECT c.src, c.dst, round(c::DOUBLE / least(a.deg, b.deg), 6) AS w
              FROM c JOIN d AS a ON a.v = c.src JOIN d AS b ON b.v = c.dst""")
def g_overlap_min(spark, sf_dir):
    return edge_weights(trade_edges(spark, sf_dir), "min_norm").withColumn("w", F.round("w", 6))


@query(E + "SELECT src, dst, 1.0::DOUBLE AS w FROM e")
def g_overlap_unit(spark, sf_dir):
    return edge_weights(trade_edges(spark, sf_dir), "unit")


@query(C + """SELECT v, l AS label FROM (
    SELECT v, l, row_number() OVER (PARTITION BY v ORDER BY sum(w) DESC, l) AS k
    FROM (SELECT src AS v, dst AS l, c AS w FROM c UNION ALL SELECT dst, src, c FROM c) GROUP BY v, l) WHERE k = 1""")
def lpa_round(spark, sf_dir):
    return label_propagation(trade_edges(spark, sf_dir), "overlap", rounds=1, mode="sync")


@query(label_rounds(2) + "SELECT v, label FROM fin")
def g_lpa_sync(spark, sf_dir):
    return trade_labels(spark, sf_dir, 2)


@query(BUCKETED)
def g_lpa_buckets(spark, sf_dir):
    """Two rounds of the default form: buckets of vertices in turn, ties by a seeded hash."""
    return propagate(multigraph_arcs(trade_multigraph(spark, sf_dir)), rounds=2, buckets=3, tie="hash", seed=42, stop=None,
                     rows=2 * link_number(spark, sf_dir))


@query(label_rounds(5) + "SELECT v, label FROM fin")
def g_lpa_five_rounds(spark, sf_dir):
    return trade_labels(spark, sf_dir)


@query(label_rounds(2) + "SELECT count(DISTINCT label) AS n FROM fin")
def g_community_count(spark, sf_dir):
    return trade_labels(spark, sf_dir, 2).agg(F.count_distinct("label").alias("n"))


@query(SWEPT)
def g_lpa(spark, sf_dir):
    """At most 30 rounds of sweeps by colour, until a round leaves the number of labels as it was."""
    return label_propagation(trade_edges(spark, sf_dir), "overlap", rounds=30, seed=42)


@query(label_rounds(2) + """, g AS (SELECT count(*)::DOUBLE AS m FROM e),
    per AS (SELECT label, sum(ends)::DOUBLE AS ends, sum(inside)::DOUBLE AS inside FROM (
        SELECT label, count(*) AS ends, 0 AS inside FROM u JOIN fin ON u.src = fin.v GROUP BY 1
        UNION ALL SELECT a.label, 0, count(*) FROM e JOIN fin AS a ON a.v = e.src JOIN fin AS b ON b.v = e.dst
        WHERE a.label = b.label GROUP BY 1) GROUP BY 1)
    SELECT round(sum(inside / m - power(ends / (2 * m), 2)), 3) AS q FROM per, g""")
def g_modularity(spark, sf_dir):
    sold = materialize(sales(spark, sf_dir), table(spark, sf_dir, "lineitem").count())
    pairs, number = trade_numbers(spark, sf_dir, sold), link_number(spark, sf_dir)
    labels = multigraph_labels(pairs.withColumnsRenamed({"a": "src", "b": "dst"}), rounds=2, number=number)
    q = materialize(modularity(undirected_edges(pairs, "a", "b", number), labels))
    release(sold)
    return q.select(F.bround("q", 3).alias("q"))
