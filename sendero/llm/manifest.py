"""A Merkle manifest of a table: trees of three children per group, with leaf places from bitmap ranks.

Each task puts the keys it sees into compressed bitmaps per group (``bitmaps``), cut into cells of 65,536 numbers. The
cells of all tasks are merged, and a directory of popcounts gives the rows before each cell: sums over 16 bits of the
key at a time, so that no sum runs over more than 65,536 rows. A leaf's place in its group is the cell's offset plus a
rank in it; no group is sorted. Places key the slots of arrays of 3**6 leaves, and an array is reduced six levels at a
time, up to the group's subroot. The subroots are the leaves of a last tree of the same kind. On the way down each array
takes the siblings above it along, which gives every leaf its proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sendero.llm import bitmaps
from sendero.operators.ordering import with_position
from sendero.operators.skew import hot_keys, lookup_join, repeat_rows, slice_rows
from sendero.session import table_path

ARITY = 3
#: Levels that one array is reduced by, and the leaves it holds then.
LEVELS = 6
BLOCK = ARITY**LEVELS
#: Rows of one cell that a task ranks together; a cell with more, whose keys repeat, is ranked in slices.
CELL_ROWS = 500_000
#: Cells are ranked by buckets of about so many rows.
BUCKET_ROWS = 32_768
#: Keys that a task holds before it packs them.
HELD_KEYS = 1_000_000
#: Arrays that a task opens at a time.
PIECE_ARRAYS = 32
SLOT = "struct<slot:int,key:bigint,digest:binary,altered:binary>"
_CELL = pa.schema([("cell", pa.string()), ("tree", pa.string()), ("chunk", pa.int64()), ("planes", pa.list_(pa.binary())), ("n", pa.int64())])
CELL_COLUMNS = "cell string, tree string, chunk bigint, planes array<binary>, n bigint"


class Climb(NamedTuple):
    """Arrays of each step, from the leaves up, and ``(tree, digest)`` of the trees' roots."""
    steps: list[DataFrame]
    roots: DataFrame


def written(df: DataFrame, name: str) -> DataFrame:
    path = table_path(df.sparkSession, f"manifest-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def encoded(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value; numbers in decimal."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, values)), 256))


def leaves(docs: DataFrame, key: str, group: str, text: str, fields: list[str], altered_keys: Column) -> DataFrame:
    """``(uid, tree, key, digest, altered)``; ``altered`` is the digest after tampering, null where that changes nothing.

    ``tree`` is the group's name after a ``=``, and empty for a null group, so that it sorts first.
    """
    values = [docs[f] for f in fields]
    cut = [F.replace(docs[f], F.lit("\n"), F.lit("")) if f == text else docs[f] for f in fields]
    changes = altered_keys & F.contains(docs[text], F.lit("\n"))
    return docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit("")).alias("tree"),
        docs[key].cast("bigint").alias("key"), leaf_digest(*values).alias("digest"),
        F.when(changes, leaf_digest(*cut)).alias("altered"))


def cell_of(tree: Column, key: Column) -> Column:
    return F.concat(F.shiftright(key, bitmaps.WIDTH).cast("string"), F.lit(":"), tree)


def _pack_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the keys of one task."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        tree = table.column("tree").combine_chunks().dictionary_encode()
        keys = table.column("key").to_numpy()
        group = tree.indices.to_numpy()
        order = np.lexsort((keys, group))
        keys, group = keys[order], group[order]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(keys) != 0) | (np.diff(group) != 0)]))
        counts = np.diff(np.concatenate([first, [len(keys)]]))
        keys, group = keys[first], group[first]
        chunks = keys >> bitmaps.WIDTH
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(chunks) != 0) | (np.diff(group) != 0)]))
        ends = np.concatenate([starts[1:], [len(keys)]])
        names = tree.dictionary.to_pylist()
        rows = [(names[group[a]], int(chunks[a]), bitmaps.planes(keys[a:b] & (bitmaps.SIZE - 1), counts[a:b]), int(counts[a:b].sum()))
                for a, b in zip(starts, ends)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
            [[f"{chunk}:{name}" for name, chunk, _, _ in rows], *map(list, zip(*rows))], _CELL)], schema=_CELL)
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= HELD_KEYS:
            yield packed()
            held.clear()
    if held:
        yield packed()


def _merge_cells(there: pa.Table) -> pa.Table:
    """The cells of one bucket, those of one name merged."""
    by: dict[tuple, list[list[bytes]]] = {}
    for row in there.select(["cell", "tree", "chunk", "planes"]).to_pylist():
        by.setdefault((row["cell"], row["tree"], row["chunk"]), []).append(row["planes"])
    merged = [(*name, bitmaps.merge(parts)) for name, parts in by.items()]
    columns = [list(c) for c in zip(*merged)] + [[bitmaps.total(planes) for *_, planes in merged]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CELL)], schema=_CELL)


def merged_cells(rows: DataFrame, buckets: int) -> DataFrame:
    """``(cell, tree, chunk, planes, n)`` of all non-null keys."""
    parts = rows.where("key is not null").select("tree", "key").mapInArrow(_pack_keys, CELL_COLUMNS)
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("cell"), F.lit(buckets)))
    return written(dealt.groupBy("bucket").applyInArrow(_merge_cells, CELL_COLUMNS), "cells")


def offsets(cells: DataFrame) -> DataFrame:
    """``(cell, before)``: rows of the tree in earlier cells, from sums over 16 bits of the cell's number at a time."""
    levels = [cells.select("cell", "tree", "chunk", F.col("chunk").alias("at"), "n")]
    for _ in range(2):
        wider = F.shiftright("at", bitmaps.WIDTH).alias("at")
        levels.append(levels[-1].groupBy("tree", wider).agg(F.sum("n").alias("n")))
    summed = None
    for level in reversed(levels):  # the widest first: its sums run over all of the tree
        within = ["tree"] if summed is None else ["tree", F.shiftright("at", bitmaps.WIDTH)]
        earlier = Window.partitionBy(*within).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        if summed is not None:
            above = summed.select("tree", F.col("at").alias("wide"), F.col("before").alias("above"))
            level = (level.withColumn("wide", F.shiftright("at", bitmaps.WIDTH)).join(above, ["tree", "wide"])
                     .withColumn("before", F.col("before") + F.col("above")).drop("wide", "above"))
        summed = level
    return summed.select("cell", "before")


def _rank_rows(there: pa.Table, cells: pa.Table) -> pa.Table:
    """Places ``before`` and counts ``copies`` of the rows of one bucket."""
    known = {c: (p, b) for c, p, b in zip(*(cells.column(n).to_pylist() for n in ("cell", "planes", "before")))}
    names = there.column("cell").combine_chunks().dictionary_encode()
    keys = there.column("key").to_numpy() & (bitmaps.SIZE - 1)
    place, copies = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    codes = names.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(names.dictionary)), "right")
    start = 0
    for name, end in zip(names.dictionary.to_pylist(), ends):
        rows = order[start:end]
        planes, before = known[name]
        smaller, copies[rows] = bitmaps.ranks(planes, keys[rows])
        place[rows] = smaller + before
        start = end
    return pa.Table.from_arrays([*(there.column(c) for c in ("uid", "tree", "key", "digest", "altered")),
                                 pa.array(place), pa.array(copies)], ["uid", "tree", "key", "digest", "altered", "place", "copies"])


def placed(rows: DataFrame, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(tree, idx, key, digest, altered)``: each leaf's place in its tree; and ``(tree, n)``.

    Null keys come first; rows with equal keys follow each other by digest.
    """
    nulls = written(rows.where("key is null").groupBy("tree").agg(F.count("*").alias("nulls")), "nulls")
    buckets = max(1, rows.count() // BUCKET_ROWS)
    cells = merged_cells(rows, buckets)
    sizes = (cells.groupBy("tree").agg(F.sum("n").alias("n")).join(nulls, "tree", "full")
             .select("tree", (F.coalesce("n", F.lit(0)) + F.coalesce("nulls", F.lit(0))).alias("n")))
    hot = hot_keys(cells, "cell", min_rows=cell_rows)
    named = rows.where("key is not null").withColumn("cell", cell_of(F.col("tree"), F.col("key")))
    asked = slice_rows(named, "cell", "uid", hot)
    held = repeat_rows(cells.join(offsets(cells), "cell").select("cell", "planes", "before"), "cell", hot)
    bucket = F.pmod(F.xxhash64("cell", "slice"), F.lit(buckets)).alias("bucket")
    ranked = (asked.groupBy(bucket).cogroup(held.groupBy(bucket)).applyInArrow(
        _rank_rows, "uid bigint, tree string, key bigint, digest binary, altered binary, place bigint, copies bigint"))
    first = rows.where("key is null").select("uid", "tree", "key", "digest", "altered", F.lit(0).cast("bigint").alias("place"),
                                             F.lit(2).cast("bigint").alias("copies"))
    ranked = written(ranked.join(nulls, "tree", "left").withColumn(
        "place", F.col("place") + F.coalesce("nulls", F.lit(0))).drop("nulls").unionByName(first), "ranked")
    columns = ["tree", F.col("place").alias("idx"), "key", "digest", "altered"]
    alone, tied = ranked.where("copies = 1"), ranked.where("copies > 1")
    if tied.isEmpty():
        return alone.select(columns), sizes
    spot = F.concat(F.coalesce(F.col("key").cast("string"), F.lit("")), F.lit(":"), F.col("tree")).alias("spot")
    ordered = written(with_position(tied.withColumn("spot", spot), F.col("spot"), F.col("digest"), F.col("uid")), "tied")
    firsts = written(ordered.groupBy("spot").agg(F.min("rn").alias("first"), F.count("*").alias("n")), "spots")
    apart = lookup_join(ordered, firsts.select("spot", "first"), "spot", "uid", hot_keys(firsts, "spot", min_rows=cell_rows))
    tied = apart.withColumn("place", F.col("place") + F.col("rn") - F.col("first"))
    return alone.select(columns).unionByName(tied.select(columns)), sizes


def digest_of(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def levels_over(digests: list[str], depth: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    levels = [digests]
    for _ in range(depth):
        below = levels[-1]
        levels.append([digest_of(below[i:i + ARITY]) for i in range(0, len(below), ARITY)])
    return levels


def siblings(levels: list[list[str]], slot: int) -> str:
    """Per level the node's place in its run and the run's others, levels separated by commas."""
    parts = []
    for level in levels[:-1]:
        run = slot - slot % ARITY
        parts.append(f"{slot - run}" + "".join(level[run:slot]) + "".join(level[slot + 1:run + ARITY]))
        slot //= ARITY
    return ",".join(parts)


def fold(digest: str, proof: str) -> str:
    """The root that a node and its siblings give."""
    for level in proof.split(",") if proof else []:
        cut = 1 + 64 * int(level[0])
        digest = sha256((level[1:cut] + digest + level[cut:]).encode()).hexdigest()
    return digest


def _hex(values) -> list[str]:
    return [v.hex() for v in values]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of so few arrays that their slots fit in memory as Python values."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_ARRAYS):
            yield batch.slice(at, PIECE_ARRAYS)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each array's topmost node, and the levels that are left above it."""
    for batch in _pieces(batches):
        slots, depths = batch.column("slots"), batch.column("depth").to_pylist()
        digests = slots.flatten().field("digest").to_pylist()
        ends = np.cumsum([0, *slots.value_lengths().to_pylist()])
        tops = [bytes.fromhex(levels_over(_hex(digests[a:b]), min(d, LEVELS))[-1][0]) for a, b, d in zip(ends, ends[1:], depths)]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("block"), pa.array([d - LEVELS for d in depths], pa.int32()),
                                          pa.array(tops, pa.binary())], ["tree", "idx", "depth", "digest"])


def depth_of(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    powers = F.array(*[F.lit(ARITY**k).cast("bigint") for k in range(40)])
    return F.size(F.filter(powers, lambda p: p < n))


def climb(nodes: DataFrame, depth: int) -> Climb:
    """Reduce ``nodes (tree, idx, depth, key, digest, altered)``, none deeper than ``depth``, to one node per tree."""
    steps, roots = [], []
    while True:
        slot = F.struct((F.col("idx") % BLOCK).cast("int").alias("slot"), "key", "digest", "altered")
        block = F.expr(f"idx div {BLOCK}")
        arrays = nodes.groupBy("tree", block.alias("block"), "depth").agg(F.array_sort(F.collect_list(slot)).alias("slots"))
        steps.append(written(arrays, f"step{len(steps)}"))
        tops = steps[-1].mapInArrow(_reduce, "tree string, idx bigint, depth int, digest binary")
        tops = tops if depth <= LEVELS else written(tops, f"tops{len(steps)}")
        roots.append(tops.where("depth <= 0").select("tree", "digest"))
        depth -= LEVELS
        if depth <= 0:
            break
        nodes = tops.where("depth > 0").withColumns({"key": F.lit(None).cast("bigint"), "altered": F.lit(None).cast("binary")})
    found = roots[0]
    for more in roots[1:]:
        found = found.unionByName(more)
    return Climb(steps, written(found, "roots"))


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, list[dict], list[list[str]], str]]:
    """Of each array: its row, slots, the nodes of its levels, and the proof of its topmost node."""
    for row, (slots, depth, above) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("slots", "depth", "above")))):
        yield row, slots, levels_over(_hex(s["digest"] for s in slots), min(depth, LEVELS)), above


def _own_proof(levels: list[list[str]], slot: int, above: str) -> str:
    own = siblings(levels, slot)
    return f"{own},{above}" if own and above else own or above


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The proof of each node of each array."""
    for batch in _pieces(batches):
        rows, idx, proofs = [], [], []
        blocks = batch.column("block").to_pylist()
        for row, slots, levels, above in _opened(batch):
            rows += [row] * len(slots)
            idx += [blocks[row] * BLOCK + s["slot"] for s in slots]
            proofs += [_own_proof(levels, i, above) for i in range(len(slots))]
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("tree").take(take), pa.array(idx, pa.int64()), pa.array(proofs, pa.string()),
                                          batch.column("subroot").take(take)], ["tree", "idx", "above", "subroot"])


def descend(steps: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest arrays with ``above``, the proof of their topmost node, and ``subroot``; ``tops (tree, above, subroot)``."""
    proofs = None
    for at in range(len(steps) - 1, -1, -1):
        arrays = steps[at].where(f"depth <= {LEVELS}").join(tops, "tree")
        if proofs is not None:
            deep = steps[at].where(f"depth > {LEVELS}").join(proofs.withColumnRenamed("idx", "block"), ["tree", "block"])
            arrays = arrays.unionByName(deep)
        if at:
            proofs = arrays.mapInArrow(_open, "tree string, idx bigint, above string, subroot string")
    return arrays


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "source", text: str = "text",
             fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), altered_keys: Column | None = None,
             cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(key, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    A leaf is the digest of ``fields``, a null as ``-``. Leaves of a group ascend by key, null keys first, equal keys by
    digest, so repeated rows are leaves of their own; a null group is a group and comes first. ``proof_sha256`` digests
    all siblings on the way to the root. Where ``altered_keys`` holds (null: not), the text is tampered with: its line
    breaks are deleted. ``folded_root`` is computed anew from that leaf and the original siblings; ``verified`` tells if
    it is the root. An empty table gives no rows. Other columns are not read.
    """
    rows = written(leaves(docs, key, group, text, list(fields), F.lit(False) if altered_keys is None else altered_keys), "leaves")
    at, sizes = placed(rows, cell_rows)
    sizes = written(sizes.withColumn("depth", depth_of(F.col("n"))), "sizes")
    largest = sizes.agg(F.max("depth").alias("d"), F.count("*").alias("trees")).first()
    below = climb(lookup_join(at, sizes.select("tree", "depth"), "tree", "idx", hot_keys(sizes, "tree")), largest["d"] or 0)

    forest = with_position(below.roots, F.col("tree")).select(
        F.lit("").alias("tree"), (F.col("rn") - 1).alias("idx"), F.lit(0).alias("depth"), F.col("digest"), F.col("tree").alias("name"))
    forest = written(forest, "forest")
    count = largest["trees"]
    depth = next(k for k in range(64) if ARITY**k >= count)
    upper = climb(forest.withColumn("depth", F.lit(depth)).withColumns(
        {"key": F.lit(None).cast("bigint"), "altered": F.lit(None).cast("binary")}).drop("name"), depth)
    top = upper.roots.first()
    root = top["digest"].hex() if top else ""
    start = upper.roots.select("tree", F.lit("").alias("above"), F.lit("").alias("subroot"))
    whole = descend(upper.steps, start).mapInArrow(_open, "tree string, idx bigint, above string, subroot string")
    tops = forest.join(whole.select("idx", "above"), "idx").select(
        F.col("name").alias("tree"), "above", F.lower(F.hex("digest")).alias("subroot"))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            rows, keys, found, proved, folded = [], [], [], [], []
            for row, slots, levels, above in _opened(batch):
                rows += [row] * len(slots)
                for i, slot in enumerate(slots):
                    proof = _own_proof(levels, i, above)
                    shown = levels[0][i]
                    keys.append(slot["key"])
                    found.append(shown)
                    proved.append(sha256("".join(level[1:] for level in proof.split(",")).encode()).hexdigest())
                    folded.append(fold(slot["altered"].hex() if slot["altered"] else shown, proof))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(found, pa.string()), batch.column("subroot").take(pa.array(rows, pa.int64())),
                 pa.array([root] * len(rows), pa.string()), pa.array(proved, pa.string()), pa.array(folded, pa.string()),
                 pa.array([f == root for f in folded], pa.bool_())],
                [key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return descend(below.steps, written(tops, "tree-tops")).mapInArrow(
        prove, f"{key} bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
