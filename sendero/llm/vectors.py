"""Nearest vectors by cosine with randomly rotated one-bit codes.

A unit vector is rotated into ``bits`` dimensions and kept as one sign bit each, beside a correction scalar: the inner
product of the vector with its own code. From a code and that scalar follows an unbiased estimate of an inner product
and a bound on its error; only vectors whose upper bound reaches the k-th best lower bound are compared exactly.
Codes lie in lists around centroids, and a query is compared with its nearest lists only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sendero.session import materialize

BITS = 256
ERROR_WIDTH = 3.0
COVERED = 0.97
SAMPLE = 20_000
LIST_ROWS = 4096
QUERY_ROWS = 512
SEED = 7


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def rotation(dim: int, bits: int) -> np.ndarray:
    """A seeded random ``dim`` x ``bits`` matrix with orthonormal rows: lengths and inner products stay."""
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((max(bits, dim), dim)))[0].T


def fit_centroids(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means on the bounded sample."""
    if not len(sample):
        return sample
    random = np.random.default_rng(SEED)
    centres = sample[random.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        filled = (sums * sums).sum(axis=1) > 0
        centres[filled] = unit(sums[filled])
    return centres


def fit_probes(sample: np.ndarray, centres: np.ndarray, k: int, covered: float, asked: int = 256) -> int:
    """How many nearest lists hold the share ``covered`` of the true neighbours, measured within the sample."""
    if len(sample) < 2:
        return 1
    asked = min(asked, len(sample))
    near = sample[:asked] @ sample.T
    near[np.arange(asked), np.arange(asked)] = -2
    top = np.argsort(-near, axis=1)[:, :min(k, len(sample) - 1)]
    place = np.argsort(np.argsort(-(sample[:asked] @ centres.T), axis=1), axis=1)
    own = (sample @ centres.T).argmax(axis=1)
    return int(np.ceil(np.quantile(np.take_along_axis(place, own[top], axis=1), covered))) + 1


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, v)`` of the vectors that take part: not null, not zero, all components there and finite.

    Vectors of another length than that of the smallest key take none either.
    """
    inf = float("inf")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("v", lambda x: x != 0)
    rows = (vectors.select(vectors[key].cast("bigint").alias("key"), vectors[vector].cast("array<double>").alias("v"))
            .where(F.col("key").isNotNull() & good))
    first = rows.agg(F.min(F.struct("key", F.size("v").alias("dim")))["dim"]).first()[0] or 0
    return rows.where(F.size("v") == first)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
            bits: int = BITS, covered: float = COVERED, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row of ``queries``, itself excluded.

    ``score`` is the exact cosine in double precision; ties go to the smaller key. All rows are indexed; only the
    centroids, and how many lists a query looks into, are fitted, on the ``sample`` rows with the smallest key hashes:
    so many that they hold the share ``covered`` of the neighbours within the sample. Equal vectors are searched once: with
    the ``k + 1`` smallest of their keys, enough for every query. Null keys, and vectors that ``usable`` leaves out,
    take no part; a repeated key counts once per vector. Fewer candidates than ``k`` give fewer rows, none give none.
    Other columns are not read. A list is cut into pieces of about ``LIST_ROWS`` vectors, its queries into blocks.
    """
    rows = usable(vectors, key, vector)
    smallest = F.row_number().over(Window.partitionBy("v").orderBy("key"))
    distinct = materialize(rows.dropDuplicates(["key", "v"]).withColumn("_n", smallest).where(F.col("_n") <= k + 1)
                           .groupBy("v").agg(F.sort_array(F.collect_list("key")).alias("keys"))
                           .select("v", "keys", F.col("keys")[0].alias("gid")))
    n = distinct.count()
    picked = distinct.select("v", F.xxhash64("gid").alias("_h"), "gid").orderBy("_h", "gid").limit(sample).collect()
    dim = len(picked[0]["v"]) if picked else 1
    lists = max(1, min(int(n**0.5 / 2), len(picked) // 16))
    known = unit(np.array([r["v"] for r in picked], float).reshape(-1, dim))
    centroids = fit_centroids(known, lists)
    probes = fit_probes(known, centroids, k, covered)
    model = distinct.sparkSession.sparkContext.broadcast((centroids, rotation(dim, bits)))

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

    def index(batches):
        centres, turn = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = unit(matrix(batch.column("v")))
            turned = own @ turn
            codes = np.packbits(turned > 0, axis=1)
            scale = np.abs(turned).sum(axis=1) / turned.shape[1] ** 0.5
            yield pa.RecordBatch.from_arrays(
                [pa.array((own @ centres.T).argmax(axis=1), pa.int64()), *(batch.column(c) for c in ("gid", "keys", "v")),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale)],
                ["list", "gid", "keys", "v", "code", "scale"])

    def probe(batches):
        centres, _ = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-(unit(matrix(batch.column("v"))) @ centres.T), axis=1, kind="stable")[:, :probes]
            for column in order.T:
                yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()), batch.column("gid"),
                                                  batch.column("v")], ["list", "gid", "v"])
    indexed = materialize(distinct.mapInArrow(
        index, "list bigint, gid bigint, keys array<bigint>, v array<double>, code binary, scale double"))
    asked = usable(queries, key, vector).join(distinct.select("v", "gid"), "v").select("key", "gid")
    wanted = distinct.join(asked.select("gid").distinct(), "gid")
    probing = materialize(wanted.select("gid", "v").mapInArrow(probe, "list bigint, gid bigint, v array<double>"))
    pieces = indexed.groupBy("list").agg(F.ceil(F.count("*") / LIST_ROWS).alias("pieces"))
    blocks = probing.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("blocks"))
    plan = materialize(pieces.join(blocks, "list"))  # a row per list, far fewer than rows

    def dealt(df: DataFrame, own: str, own_parts: str, other: str, other_parts: str) -> DataFrame:
        return (df.join(plan, "list").withColumn(own, F.pmod(F.xxhash64("gid"), F.col(own_parts)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other_parts) - 1)))
                .drop("pieces", "blocks"))

    def search(there: pa.Table, here: pa.Table) -> pa.Table:
        schema = pa.schema([("gid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not there.num_rows or not here.num_rows:
            return schema.empty_table()
        turn = model.value[1]
        x, q = (unit(matrix(t.column("v").combine_chunks())) for t in (there, here))
        raw_x, raw_q = (matrix(t.column("v").combine_chunks()) for t in (there, here))
        codes = np.frombuffer(b"".join(there.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
        signs = np.unpackbits(codes, axis=1)[:, :turn.shape[1]].astype(np.float32) * 2 - 1
        scale = there.column("scale").to_numpy()
        width = turn.shape[1]
        guess = (signs @ (q @ turn).T.astype(np.float32)).T / (scale * width**0.5)
        error = ERROR_WIDTH * np.sqrt((1 - np.minimum(scale, 1) ** 2) / (width - 1)) / scale
        low, high = guess - error, guess + error
        keep = min(k + 1, len(x))
        least = -np.partition(-low, keep - 1, axis=1)[:, keep - 1]
        keys = there.column("keys").to_pylist()
        gids, found, scores = [], [], []
        for i, gid in enumerate(here.column("gid").to_pylist()):
            near = np.flatnonzero(high[i] >= least[i])
            exact = cosine(raw_x[near], raw_q[i])
            best = sorted((-s, key) for s, at in zip(exact.tolist(), near.tolist()) for key in keys[at])[:k + 1]
            gids += [gid] * len(best)
            found += [key for _, key in best]
            scores += [-s for s, _ in best]
        return pa.Table.from_arrays([pa.array(gids, pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.float64())],
                                    schema=schema)
    names = ["list", "piece", "block"]
    local = (dealt(indexed, "piece", "pieces", "block", "blocks").groupBy(*names)
             .cogroup(dealt(probing, "block", "blocks", "piece", "pieces").groupBy(*names))
             .applyInArrow(search, "gid bigint, vec_id bigint, score double"))
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("away"), "vec_id")))
    merged = local.groupBy("gid").agg(F.slice(best, 1, k + 1).alias("best"))
    mine = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("key")), 1, k)
    return (asked.join(merged, "gid").select(F.col("key").alias("query_id"), F.posexplode(mine).alias("at", "b"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
                    (-F.col("b.away")).alias("score")))


def cosine(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores wherever they stand."""
    return (many * one).sum(axis=1) / (np.sqrt((many * many).sum(axis=1)) * np.sqrt((one * one).sum()))
