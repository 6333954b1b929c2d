"""Whitening against numpy's eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sendero.llm import queries, whitening

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, component string, n double"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v, "clash", 0.5) for k, v in vectors], SCHEMA).repartition(3)


def plain(vectors, components=4):
    """Rows by exact integers and numpy's solver; vectors have to be of one length."""
    usable = [(k, [math.floor(256 * float(np.float32(c))) for c in v]) for k, v in vectors
              if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted(set(tuple(x) for _, x in usable))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    away = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    covariance = away.T @ away / n
    values, units = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    out = []
    for key, x in usable:
        spread = np.array([n * c - s for c, s in zip(x, sums)], float) / n
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        out += [(key, j + 1, n, deviation, spread @ units[:, o] / math.sqrt(values[o]), values[o] / np.trace(covariance))
                for j, o in enumerate(order) if values[o] > 1e-9 * values.max()]
    return out


def compare(rows, want):
    got = sorted(rows, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [r[:4] for r in want]
    assert np.allclose([r.explained for r in got], [r[5] for r in want], rtol=1e-9)
    for component in {r.component for r in got}:
        mine = np.array([r.whitened for r in got if r.component == component])
        theirs = np.array([r[4] for r in want if r[1] == component])
        assert np.allclose(mine, theirs, atol=1e-7) or np.allclose(mine, -theirs, atol=1e-7)
    assert all(r.identity_error < 1e-9 for r in got)


def test_random_vectors_with_odd_ones(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, (rng.standard_normal(6) * [3, 2, 1, .5, .2, .1]).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(1000, vectors[5][1]), (1000, vectors[5][1]), (None, vectors[6][1]), (5, [0.0] * 6)]
    odd = [(2000, None), (2001, [1.0] * 5 + [NAN]), (2002, [1.0] * 5 + [None]), (2003, [INF] * 6), (2004, [])]
    got = whitening.whiten(frame(spark, vectors + odd)).collect()
    want = plain(vectors)
    for key in (1000, None):  # repeated rows come out as often as they go in
        assert sum(r.vec_id == key for r in got) == sum(r[0] == key for r in want)
    compare([r for r in got if r.vec_id != 1000], [r for r in want if r[0] != 1000])


def test_vectors_of_other_lengths_take_no_part(spark):
    vectors = [(i, [float(i), float(i * i % 7)]) for i in range(20)]
    compare(whitening.whiten(frame(spark, vectors + [(50, [1.0]), (51, [1.0, 2.0, 3.0])])).collect(), plain(vectors))


def test_fewer_components_than_asked(spark):
    line = [(i, [i * 0.5, i * 1.0, 7.0]) for i in range(10)]
    compare(whitening.whiten(frame(spark, line)).collect(), plain(line))
    for none in ([], [(1, None)], [(1, [2.0, 3.0])] * 3, [(i, [4.0, 4.0]) for i in range(5)]):
        assert whitening.whiten(frame(spark, none)).collect() == []


def test_a_mean_far_from_zero_and_large_numbers(spark):
    rng = np.random.default_rng(3)
    far = [(i, (rng.standard_normal(3) + 2000).astype(np.float32).tolist()) for i in range(200)]
    compare(whitening.whiten(frame(spark, far)).collect(), plain(far))
    wide = [(i, (rng.standard_normal(3) * 1e9).astype(np.float32).tolist()) for i in range(50)]
    got = whitening.whiten(frame(spark, wide), components=3).collect()
    exact = {r[0]: r[3] for r in plain(wide)}
    assert {r.vec_id: int(r.deviation_exact) for r in got} == exact and all(r.deviation is None for r in got)
    assert all(r.identity_error < 1e-4 for r in got)
    huge = [(i, [3e38, -3e38, float(i)]) for i in range(5)]
    assert len(whitening.whiten(frame(spark, huge)).collect()) > 0


@pytest.mark.parametrize("dim, rank", [(1, 1), (2, 2), (9, 9), (16, 5), (7, 0), (33, 33)])
def test_factor_and_rotations(dim, rank):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((dim, rank))
    matrix = base @ base.T
    factor = whitening.pivoted_cholesky(matrix)
    assert factor.shape == (dim, rank) and np.allclose(factor @ factor.T, matrix)
    turned = whitening.one_sided_jacobi(factor)
    values = (turned * turned).sum(axis=0)
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(matrix))[::-1][:rank])
    assert np.allclose(turned @ turned.T, matrix) and np.allclose(turned.T @ turned, np.diag(values), atol=1e-9)


def test_pivots_fall_and_the_factor_is_triangular():
    rng = np.random.default_rng(8)
    base = rng.standard_normal((12, 12)) * np.arange(1, 13)
    factor = whitening.pivoted_cholesky(base @ base.T)
    rows = np.argsort((factor != 0).sum(axis=1), kind="stable")
    assert (np.triu(factor[rows], 1) == 0).all() and (np.diff(np.diag(factor[rows])) <= 0).all()


def test_the_fit_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.standard_normal(5).astype(np.float32).tolist()) for i in range(400)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    runs = [whitening.whiten(df.repartition(p)).drop("identity_error") for p in (1, 7)]
    assert sorted(map(tuple, runs[0].collect())) == sorted(map(tuple, runs[1].collect()))


def test_whitening_query(spark, sf_dir):
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    compare(queries.op13_jacobi_whitening(spark, sf_dir).collect(), plain(vectors))
