"""Undirected simple graphs: neighbourhood overlap, label propagation, modularity.

``edges`` is ``(src, dst)`` with ``src <= dst`` and no repeats, a loop being ``src = dst``. ``arcs`` is
the same graph with both directions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sendero.operators.cells import Cells, one_key_per_part, place
from sendero.operators.colouring import colour, digest
from sendero.operators.skew import MIN_HOT_ROWS, hot_keys, lookup_join, slice_rows
from sendero.session import materialize, materialize_by, materialize_in_place, parts_for, release

WEIGHTINGS = ("overlap", "normalized", "min_norm", "unit")
MODES = ("sweep", "semi", "sync")
FRACTIONAL = ("normalized", "min_norm")
#: Colours that are swept one by one; those from the last one on are swept together.
MAX_CLASSES = 16
#: Most edges whose lists a task keeps while others are looked up in them, fewest that are worth a task, usual blocks of vertices.
CELL_EDGES, MIN_CELL_EDGES, MIN_BLOCKS = 32_000_000, 100_000, 4
#: Edges from which on neighbour lists are sent in several passes.
PASS_EDGES = 32_000_000


def undirected_edges(df: DataFrame, a: str, b: str, rows: int | None = None) -> DataFrame:
    """Canonical edges: reversed and repeated pairs collapse.

    Pairs go to as many tasks as their number takes, whatever the session's partitions, so that no task has to tell
    apart more than it should hold. ``rows`` is that number or a little more, if known.
    """
    low, high = F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")
    pairs = df.dropna(subset=[a, b]).select(low, high)
    return pairs.repartition(parts_for(df.sparkSession, df.count() if rows is None else rows), "src", "dst").distinct()


def symmetrize(edges: DataFrame) -> DataFrame:
    """Both directions of every edge, a loop once, other columns kept. Canonical input needs no distinct."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    there = F.struct("src", "dst")
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))
    ways = F.when(F.col("src") == F.col("dst"), F.array(there)).otherwise(F.array(there, back))
    return edges.select(F.explode(ways).alias("arc"), *rest).select("arc.*", *rest)


def neighbour_counts(edges: DataFrame) -> DataFrame:
    """``(v, n, loop)``: size of the neighbour set, which holds ``v`` itself if ``v`` has a loop."""
    return (symmetrize(edges.select("src", "dst")).groupBy(F.col("src").alias("v"))
            .agg(F.count("*").alias("n"), F.max((F.col("src") == F.col("dst")).cast("int")).alias("loop")))


def _with_end_counts(edges: DataFrame, counts: DataFrame, hot: DataFrame) -> DataFrame:
    """Neighbour count and loop mark of both ends beside each edge."""
    for key, other in (("src", "dst"), ("dst", "src")):
        ends = counts.select(F.col("v").alias(key), F.col("n").alias(f"n_{key}"), F.col("loop").alias(f"loop_{key}"))
        edges = lookup_join(edges, ends, key, other, hot)
    return edges


def _cells(edges: int, parallelism: int) -> tuple[int, int]:
    """Blocks of vertices on either side of a cell, and slices of the cells, so that none holds more than ``CELL_EDGES``
    edges and there are enough to keep all cores busy, if there are edges for that."""
    busy = min(3 * parallelism, math.ceil(edges / MIN_CELL_EDGES))
    blocks = max(1, min(MIN_BLOCKS, math.ceil(math.sqrt(busy))), math.ceil(math.sqrt(edges / CELL_EDGES)))
    return blocks, max(1, -(-busy // blocks**2))


def _with_triangles(counted: DataFrame) -> DataFrame:
    """The number ``t`` of triangles through each edge beside it; loops are in none. ``counted`` is released.

    Edges point from the end with fewer neighbours to the one with more, so no vertex keeps more than
    sqrt(2 * edges) out-neighbours, hubs included. Common out-neighbours of an edge's two ends give each triangle once;
    neighbour pairs are never listed. Vertices are dealt to a few blocks. Cell (i, j) has the edges from block i to block
    j, as lists; it gets the out-neighbours in i and in j of every vertex once, not once for every edge, and looks those in
    i up. What is moved and kept is a few times the edges, whatever the length of the lists. Of more than ``PASS_EDGES`` edges the
    cells of one i after the other are sent their lists, so that not all are on disk at once.
    """
    spark = counted.sparkSession
    number = counted.count()
    blocks, slices = _cells(number, spark.sparkContext.defaultParallelism)
    parts = parts_for(spark, number)
    keys = F.array(*[F.lit(k).cast("bigint") for k in one_key_per_part(spark, blocks * blocks * slices)])

    def cell(i: Column, j: Column, s: Column) -> Column:
        return F.get(keys, ((i * blocks + j) * slices + s).cast("int"))

    def block(v: str) -> Column:
        return F.pmod(F.xxhash64(v), F.lit(blocks))
    forward = (F.col("n_src") < F.col("n_dst")) | ((F.col("n_src") == F.col("n_dst")) & (F.col("src") < F.col("dst")))
    pointed = counted.where("src <> dst").select(
        F.when(forward, F.col("src")).otherwise(F.col("dst")).alias("a"),
        F.when(forward, F.col("dst")).otherwise(F.col("src")).alias("b"))
    onward = materialize(pointed.repartition(parts, "a").groupBy("a").agg(
        *[F.collect_list(F.when(block("b") == i, F.col("b"))).alias(f"out{i}") for i in range(blocks)]))

    slice_of = F.pmod(F.xxhash64("a", F.lit("slice")), F.lit(slices))
    known = [c for c in counted.columns if c not in ("src", "dst")]
    passes = max(1, min(blocks, -(-number // PASS_EDGES)))
    cells = blocks * blocks * slices
    total = counted.withColumn("t", F.lit(0).cast("bigint"))
    for turn in range(passes):
        rows = range(turn, blocks, passes)
        pairs = F.array(*[F.struct(cell(F.lit(i), F.lit(j), slice_of).alias("cell"), F.col(f"out{i}").alias("bs"), F.col(f"out{j}").alias("cs"))
                          for i in rows for j in range(blocks)])
        sent = onward.select("a", F.explode(pairs).alias("x")).select("x.cell", "a", "x.bs", "x.cs").where("size(bs) > 0 and size(cs) > 0")
        lists = F.array(*[F.struct(cell(block("a"), F.lit(j), F.lit(s)).alias("cell"), F.col(f"out{j}").alias("out"))
                          for j in range(blocks) for s in range(slices)])
        holders = onward if passes == 1 else onward.where(block("a").isin(list(rows)))
        held = holders.select(F.col("a").alias("b"), F.explode(lists).alias("x")).select("x.cell", "b", "x.out").where("size(out) > 0")

        met = sent.repartition(cells, "cell").select("cell", "a", F.explode("bs").alias("b"), "cs").join(
            held.repartition(cells, "cell").hint("shuffle_hash"), ["cell", "b"])
        closed = met.select("a", "b", F.array_intersect("cs", "out").alias("cs")).where("size(cs) > 0")
        ends = [F.struct(F.col("a").alias("p"), F.col("b").alias("q"))] + [
            F.struct(F.col(v).alias("p"), F.col("c").alias("q")) for v in ("a", "b")]
        sides = closed.select("a", "b", F.explode("cs").alias("c")).select(F.explode(F.array(*ends)).alias("side")).select("side.*")
        through = sides.select(F.least("p", "q").alias("src"), F.greatest("p", "q").alias("dst"),
                               *[F.lit(None).cast(counted.schema[c].dataType).alias(c) for c in known], F.lit(1).cast("bigint").alias("t"))
        both = total.unionByName(through)
        now = materialize_in_place(both.repartition(parts, "src", "dst").groupBy("src", "dst")
                                   .agg(*[F.max(c).alias(c) for c in known], F.sum("t").alias("t")))
        release(counted if turn == 0 else total)
        total = now
    release(onward)
    return total


def edge_weights(edges: DataFrame, weighting: str = "overlap", min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """``(src, dst, w)`` of every edge, those without a common neighbour included.

    overlap: common neighbours; normalized: their share of all neighbours of both ends; min_norm: their
    share of the smaller neighbour set; unit: 1.
    """
    return _weighted(edges, weighting, min_hot_rows)[0]


def _weighted(edges: DataFrame, weighting: str, min_hot_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """``edge_weights`` and the tables that these are read from."""
    if weighting not in WEIGHTINGS:
        raise ValueError(f"weighting must be one of {WEIGHTINGS}, not {weighting!r}")
    if weighting == "unit":
        return edges.select("src", "dst", F.lit(1.0).alias("w")), []
    edges = materialize(edges.select("src", "dst"))
    counts = materialize(neighbour_counts(edges))
    hot = hot_keys(counts, "v", min_rows=min_hot_rows)
    counted = materialize(_with_end_counts(edges, counts, hot), edges.count())
    release(edges, counts, hot)
    joined = _with_triangles(counted)
    # A vertex with a loop neighbours itself, so it is a common neighbour of both ends of all its edges.
    common = F.when(F.col("src") == F.col("dst"), F.col("n_src")).otherwise(
        F.col("t") + F.col("loop_src") + F.col("loop_dst"))
    below = {"overlap": F.lit(1), "normalized": F.col("n_src") + F.col("n_dst") - common,
             "min_norm": F.least("n_src", "n_dst")}[weighting]
    return joined.select("src", "dst", (common.cast("double") / below).alias("w")), [joined]


def _exact(weighting: str) -> Column:
    """Weights whose sums do not depend on the order of addition."""
    return F.col("w").cast("decimal(20,12)" if weighting in FRACTIONAL else "bigint").alias("w")


def _tie_order(tie: str, seed: int, step: int) -> list[Column]:
    if tie == "min":
        return [F.col("label")]
    return [digest(F.lit(str(seed)), F.lit(str(step)), "v", "label"), F.col("label")]


def pick_labels(cells: Cells, labels: DataFrame, tie: str = "min", seed: int = 0, step: int = 0) -> DataFrame:
    """``(v, label)``: the heaviest label among each vertex's neighbours, of the vertices that arcs of ``cells`` lead to.

    Scores tie when equal to nine decimals; only what ties is ordered further. Votes do not leave their cell, but those for a vertex
    whose arcs lie in several. To be materialized in place.
    """
    votes = (cells.met(labels.withColumnRenamed("v", "src")).groupBy("cell", "split", F.col("dst").alias("v"), "label")
             .agg(F.sum("w").alias("score")))

    def heaviest(votes: DataFrame, *by: str) -> DataFrame:
        place = F.rank().over(Window.partitionBy(*by).orderBy(F.desc("score")))
        first = votes.withColumn("score", F.round("score", 9)).withColumn("place", place).where("place = 1")
        order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_tie_order(tie, seed, step))])
        return first.groupBy(*by).agg(F.min_by("label", order).alias("label")).select("v", "label")
    if not cells.any_split:
        return heaviest(votes, "cell", "v")
    apart = votes.where("split").groupBy("v", "label").agg(F.sum("score").alias("score"))
    return heaviest(votes.where("not split"), "cell", "v").unionByName(heaviest(apart, "v"))


def layout(arcs: DataFrame, hot: DataFrame, rows: int | None = None) -> DataFrame:
    """Arcs placed by source for a join with a row per source, hot sources spread over slices; ``rows`` is their number, if known."""
    placed = slice_rows(arcs, "src", "dst", hot).select("src", "slice", "dst", "w")
    return materialize_by(placed, arcs.count() if rows is None else rows, "src", "slice")


def propagate(arcs: DataFrame, rounds: int = 30, buckets: int = 1, tie: str = "min", seed: int = 42,
              stop: str | None = "count", min_hot_rows: int = MIN_HOT_ROWS, classes: DataFrame | None = None,
              rows: int = 0) -> DataFrame:
    """Label propagation over weighted ``arcs`` ``(src, dst, w)`` with exact ``w``.

    Vertices are split into ``buckets`` by a seeded hash, or as ``classes (v, bucket)`` says, numbered from 0 and fewer
    than ``buckets``; a round updates one bucket after the other, each seeing the labels the earlier ones just took. One
    bucket is the synchronous form. ``stop``: "count" ends when a round leaves the number of labels unchanged, "labels"
    when it changes no label, None never. With ``classes`` given, ``arcs`` should be materialized. ``rows`` is about how many
    rows ``arcs`` are made from, if they are many more than the arcs or the session's partitions should hold.
    """
    given = classes is not None
    return _propagate(arcs if given else materialize(arcs, rows), rounds, buckets, tie, seed, stop, min_hot_rows, classes)


def _propagate(arcs: DataFrame, rounds: int, buckets: int, tie: str, seed: int, stop: str | None, min_hot_rows: int,
               classes: DataFrame | None) -> DataFrame:
    """``propagate`` of materialized ``arcs``, which are released unless ``classes`` are given."""
    given = classes is not None
    sources = materialize(arcs.groupBy(F.col("src").alias("v")).agg(F.count("*").alias("n")))
    if classes is None:
        number = F.conv(F.substring(digest(F.lit(str(seed)), "v"), 1, 8), 16, 10).cast("bigint") % buckets
        classes = sources.select("v", number.alias("bucket"))
    hot = hot_keys(sources, "v", min_rows=min_hot_rows)
    classes = materialize(classes)
    laid = _deal(arcs, classes, buckets, hot, not given)
    return _rounds(laid, classes, sources, rounds, tie, seed, stop)


def _deal(arcs: DataFrame, classes: DataFrame, buckets: int, hot: DataFrame, last: bool) -> list[list[Cells]]:
    """Cells of the arcs to each bucket. ``arcs`` are released if this is the ``last`` that reads them."""
    if buckets == 1:
        laid = [place(arcs, hot, arcs.count())]
    else:
        dealt = materialize(lookup_join(arcs, classes.withColumnRenamed("v", "dst"), "dst", "src", hot))
        if last:
            release(arcs)
        sizes = {r.bucket: r.n for r in dealt.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        laid = [place(dealt.where(F.col("bucket") == b), hot, sizes.get(b, 0)) for b in range(buckets)]
        release(dealt)
    if last and buckets == 1:
        release(arcs)
    return laid


def _rounds(laid: list[list[Cells]], classes: DataFrame, sources: DataFrame, rounds: int, tie: str, seed: int, stop: str | None) -> DataFrame:
    """Label propagation over cells by bucket. Every step deletes the labels that the one before it has left."""
    labels = [[materialize(classes.where(F.col("bucket") == b).select("v", F.col("v").alias("label")))] for b in range(len(laid))]

    def everywhere() -> DataFrame:
        return reduce(DataFrame.unionByName, [x for of_bucket in labels for x in of_bucket])

    count = sources.count() if stop == "count" else None
    try:
        for step in range(1, rounds + 1):
            before, old = everywhere(), []
            for b, tables in enumerate(laid):
                now = [materialize_in_place(pick_labels(cells, everywhere(), tie, seed, step)) for cells in tables]
                old += labels[b]
                labels[b] = now
            done = False
            if stop == "count":
                now = everywhere().select("label").distinct().count()
                done, count = now == count, now
            elif stop == "labels":
                done = everywhere().join(before.withColumnRenamed("label", "old"), "v").where("label <> old").isEmpty()
            release(*old)
            if done:
                break
    finally:
        for tables in laid:
            for cells in tables:
                cells.release()
    return everywhere()


def sweep(arcs: DataFrame, rounds: int = 30, seed: int = 42, tie: str = "hash", stop: str | None = "count",
          min_hot_rows: int = MIN_HOT_ROWS, max_classes: int = MAX_CLASSES) -> DataFrame:
    """Label propagation in which every vertex sees the labels that its neighbours have already taken in this round.

    The graph is coloured, and a round updates one colour after the other. No two vertices of a colour are neighbours, so
    this equals updating one vertex at a time in the order of (colour, v). Of a graph that needs more than ``max_classes`` colours, the
    colours from ``max_classes - 1`` on are updated together, each vertex seeing its neighbours' last labels there.
    """
    return _sweep(materialize(arcs), rounds, seed, tie, stop, min_hot_rows, max_classes)


def _sweep(arcs: DataFrame, rounds: int, seed: int, tie: str, stop: str | None, min_hot_rows: int, max_classes: int) -> DataFrame:
    """``sweep`` of materialized ``arcs``, which are released."""
    sources = materialize(arcs.groupBy(F.col("src").alias("v")).agg(F.count("*").alias("n")))
    coloured = colour(arcs, seed, min_hot_rows, sources).select("v", F.least("colour", F.lit(max_classes - 1)).alias("bucket"))
    used = coloured.agg(F.max("bucket")).first()[0]
    classes = materialize(coloured)
    laid = _deal(arcs, classes, 1 if used is None else used + 1, hot_keys(sources, "v", min_rows=min_hot_rows), True)
    return _rounds(laid, classes, sources, rounds, tie, seed, stop)


def label_propagation(edges: DataFrame, weighting: str = "overlap", rounds: int = 30, seed: int = 42,
                      mode: str = "sweep", tie: str | None = None, stop: str | None = "count",
                      min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Communities ``(v, label)`` of a simple graph, weighted by neighbourhood overlap.

    mode "sweep" updates one colour of vertices after the other, so that each sees all labels taken before; "semi" updates
    four hashed vertex buckets in turn; both draw ties by a seeded digest. "sync" updates all vertices from the labels of
    the last round, the smallest label winning ties.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    weights, tables = _weighted(edges, weighting, min_hot_rows)
    arcs = materialize(symmetrize(weights.select("src", "dst", _exact(weighting))))
    release(*tables)
    tie = tie or ("min" if mode == "sync" else "hash")
    if mode == "sweep":
        return _sweep(arcs, rounds, seed, tie, stop, min_hot_rows, MAX_CLASSES)
    return _propagate(arcs, rounds, 4 if mode == "semi" else 1, tie, seed, stop, min_hot_rows, None)


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct("src", "dst"), F.struct(
        F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("arc")).select("arc.*")


def _counted(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("src", "dst").agg(F.count("*").alias("w"))


def multigraph_arcs(links: DataFrame) -> DataFrame:
    """Arcs of a directed multigraph with its direction ignored; ``w`` counts the links between the ends."""
    return _counted(_both_ways(links))


def multigraph_labels(links: DataFrame, rounds: int = 5, min_hot_rows: int = MIN_HOT_ROWS, number: int = 0) -> DataFrame:
    """A fixed number of synchronous rounds over a directed multigraph, every link one vote each way; ``number`` of links, if known.

    ``links`` are read a few times, more often if there are many, so they should be made of tables or materialized rows.
    """
    both = _both_ways(links)
    rows = 2 * (number or links.count())
    sources = materialize(both.groupBy(F.col("src").alias("v")).agg(F.count("*").alias("n")), rows)
    hot = hot_keys(sources, "v", min_rows=min_hot_rows)
    laid = place(both, hot, rows, _counted)
    return _rounds([laid], sources.select("v", F.lit(0).alias("bucket")), sources, rounds, "min", 0, None)


def modularity(edges: DataFrame, labels: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """One row ``q``: unweighted modularity of ``labels`` ``(v, label)``; NULL without edges."""
    edges = materialize(edges.select("src", "dst"))
    degrees = materialize(edges.select(F.explode(F.array("src", "dst")).alias("v")).groupBy("v")
                          .agg(F.count("*").alias("n")))
    hot = hot_keys(degrees, "v", min_rows=min_hot_rows)
    ends = edges
    for key, other in (("src", "dst"), ("dst", "src")):
        ends = lookup_join(ends, labels.select(F.col("v").alias(key), F.col("label").alias(f"l_{key}")),
                           key, other, hot)
    inner = ends.where("l_src = l_dst").groupBy(F.col("l_src").alias("label")).agg(F.count("*").alias("inside"))
    total = degrees.join(labels, "v").groupBy("label").agg(F.sum("n").alias("ends"))
    per_label = total.join(inner, "label", "left").select(
        F.coalesce("inside", F.lit(0)).alias("inside"), F.col("ends").cast("double").alias("ends"))
    sums = per_label.agg(F.sum("inside").alias("inside"), F.sum("ends").alias("ends"),
                         F.sum(F.col("ends") * F.col("ends")).alias("squares"))
    return sums.select((F.try_divide(F.col("inside") * 2, F.col("ends"))
                        - F.try_divide(F.col("squares"), F.col("ends") * F.col("ends"))).alias("q"))
