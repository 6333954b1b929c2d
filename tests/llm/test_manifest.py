"""The Merkle manifest against a plain program, bitmaps against sorted lists."""

from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from sendero.llm import bitmaps, manifest
from sendero.operators.ordering import with_position

H = lambda text: sha256(text.encode()).hexdigest()
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def enc(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Levels of a plain tree of three."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return levels


def walk(levels, i):
    for level in levels[:-1]:
        run = i // 3 * 3
        yield level[run:i], level[i + 1:run + 3]
        i //= 3


def plain_manifest(rows, altered):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, H("".join(map(enc, row))), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for *_, leaf, _ in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (*_, leaf, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            path = [*walk(trees[s], i), *walk(top, at)]
            shown = H("".join(map(enc, (*row[:4], row[4] and row[4].replace("\n", ""))))) if altered(row[0]) else leaf
            for left, right in path:
                shown = H("".join([*left, shown, *right]))
            out.append((row[0], leaf, trees[s][-1][0], top[-1][0], H("".join(h for left, right in path for h in left + right)),
                        shown, shown == top[-1][0]))
    return Counter(out)


def check(spark, rows, parts=3, **conf):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, "
                               "tree string, idx int").repartition(parts)
    got = manifest.manifest(df, altered_keys=F.col("doc_id") % 2 == 0, **conf)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == plain_manifest(rows, lambda k: k is not None and k % 2 == 0)


def test_trees_of_all_depths_with_nulls_and_ties(spark):
    rng = random.Random(4)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 4, "é": 28, "Z": 730, "zz": 2200, "": 5, None: 9}
    rows = []
    for source, n in sizes.items():
        keys = rng.sample(range(-100_000, 400_000), n)
        rows += [(k, source, rng.choice([None, "de"]), rng.choice([None, k]), rng.choice([None, "", "a\nb", "é\n", "plain"])) for k in keys]
    rows += [(7, "d", "de", 1, "same")] * 4 + [(7, "d", "de", 1, "other"), (8, "d", "de", 1, "x")]
    rows += [(None, "b", None, None, None)] * 3 + [(None, None, "x", 2, "a\nb"), (2**62, "c", None, None, "far\n"), (-2**62, "c", None, None, "")]
    check(spark, rows)


@pytest.mark.parametrize("cell_rows", [10, manifest.CELL_ROWS])
def test_a_hot_source_and_a_hot_key(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(manifest, "BUCKET_ROWS", 100)
    rows = [(i * 3, "hot", "en", i, "t\n") for i in range(800)] + [(5, "hot", "en", 5, f"v{i % 40}") for i in range(300)]
    rows += [(i, f"s{i}", "en", i, "w") for i in range(100)]
    check(spark, rows, parts=7, cell_rows=cell_rows)


def test_no_rows_and_one_row(spark):
    check(spark, [])
    check(spark, [(2, None, None, None, "a\n")])


def test_long_text(spark):
    check(spark, [(1, "s", "en", 9, "word \n" * 200_000), (2, "s", "en", 9, "é\n" * 100_000)])


@pytest.mark.parametrize("seed", range(6))
def test_packed_sets_and_ranks(seed):
    rng = np.random.default_rng(seed)
    numbers = [np.arange(1000, 60_000), rng.choice(65_536, 900, replace=False), rng.choice(65_536, 40_000, replace=False),
               np.array([0, 65_535]), np.array([], np.int64), np.concatenate([np.arange(9), np.arange(500, 900), [65_535]])][seed]
    numbers = np.sort(numbers).astype(np.int64)
    packed = bitmaps.pack(numbers)
    assert len(packed) <= 1 + min(2 * len(numbers), 8192) and (bitmaps.unpack(packed) == numbers).all()
    assert bitmaps.popcount(packed) == len(numbers)
    asked = np.arange(65_536)
    smaller, held = bitmaps.rank(packed, bitmaps.directory(packed), asked)
    assert (smaller == np.searchsorted(numbers, asked)).all() and (held == np.isin(asked, numbers)).all()


def test_merged_cells_count_repeats():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 65_536, n) for n in (1, 50, 5000, 90_000)] + [np.full(1000, 17)]
    cells = [bitmaps.planes(*np.unique(p, return_counts=True)) for p in parts]
    every = np.sort(np.concatenate(parts))
    merged = bitmaps.merge(cells)
    asked = np.arange(0, 65_536, 7)
    smaller, own = bitmaps.ranks(merged, asked)
    assert bitmaps.total(merged) == len(every)
    assert (smaller == np.searchsorted(every, asked)).all()
    assert (own == np.searchsorted(every, asked, "right") - np.searchsorted(every, asked)).all()


def test_offsets_over_far_cells(spark):
    chunks = [-2**40, -2**17, -1, 0, 1, 65_535, 65_536, 2**30, 2**46]
    cells = spark.createDataFrame([(f"{c}:t", "t", c, i + 1) for i, c in enumerate(chunks)], "cell string, tree string, chunk bigint, n bigint")
    got = {r.cell: r.before for r in manifest.offsets(cells).collect()}
    assert got == {f"{c}:t": sum(range(1, i + 1)) for i, c in enumerate(chunks)}


def test_proofs_fold_to_the_root():
    levels = manifest.levels_over([H(str(i)) for i in range(100)], 5)
    assert all(manifest.fold(levels[0][i], manifest.siblings(levels, i)) == levels[-1][0] for i in range(100))
    assert manifest.fold(H("x"), manifest.siblings(levels, 3)) != levels[-1][0] and manifest.fold(H("x"), "") == H("x")


def test_positions_of_trees(spark):
    df = spark.createDataFrame([("=b",), ("",), ("=é",), ("=Z",)], "tree string")
    assert {r.tree: r.rn for r in with_position(df, F.col("tree")).collect()} == {"": 1, "=Z": 2, "=b": 3, "=é": 4}
