"""Nearest vectors and the whole pipeline."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from sendero.llm import queries, vectors
from sendero.llm.vectors import nearest
from tests.llm.test_duplicates import brute_components
from tests.llm.test_text_operators import BASE, base_spans


def brute(rows, asked, k):
    ids, matrix = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q, v in asked:
        scores = vectors.cosine(matrix, np.array(v, float))
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_copies_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_ROWS", 16)
    monkeypatch.setattr(vectors, "QUERY_ROWS", 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 16))
    good = [(i, (centres[i % 6] + 0.3 * rng.normal(size=16)).astype("float32").tolist()) for i in range(300)]
    good += [(1000 + i, good[0][1]) for i in range(120)]  # one vector, very common
    bad = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] + [1.0] * 15), (2003, [None] + [1.0] * 15),
           (2004, [float("inf")] * 16), (2005, [1.0, 2.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame([(k, v, "x", 0.5) for k, v in good + bad],
                               "vec_id bigint, embedding array<float>, rank string, score double").repartition(4)
    asked = df.where("vec_id % 20 = 0 or vec_id >= 1990")
    got = listed(nearest(df, asked, 5, covered=1.0))
    want = brute(good, [(k, v) for k, v in good if k % 20 == 0], 5)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) > 0.97
    assert got[1000] == want[1000] and got[0] == want[0]  # ties go to the smaller id
    few = df.where("vec_id < 3")
    assert listed(nearest(few, few, 5)) == brute(good[:3], good[:3], 5)
    assert nearest(df.where("vec_id >= 2000"), df, 5).count() == 0 and nearest(df, df.where("vec_id < -1"), 5).count() == 0


def test_recall(spark, sf_dir):
    rows = duckdb.connect().execute(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet' ORDER BY 1").fetchall()
    want = brute(rows, [r for r in rows if r[0] % 50 == 0], 5)
    got = listed(queries.op6_one_bit_neighbours(spark, sf_dir))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (5 * len(want)) >= 0.9


def test_error_bound_holds():
    rng = np.random.default_rng(4)
    x, q = vectors.unit(rng.normal(size=(2000, 64))), vectors.unit(rng.normal(size=(50, 64)))
    turn = vectors.rotation(64, vectors.BITS)
    turned = x @ turn
    scale = np.abs(turned).sum(axis=1) / vectors.BITS**0.5
    guess = (np.sign(turned) @ (q @ turn).T).T / (scale * vectors.BITS**0.5)
    error = vectors.ERROR_WIDTH * np.sqrt((1 - scale**2) / (vectors.BITS - 1)) / scale
    assert np.abs(turned @ (q @ turn).T - x @ q.T).max() < 1e-9
    assert (np.abs(guess - q @ x.T) > error).mean() < 0.005


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir).checkpoint()
        assert kept.columns == columns
        seen[name] = ({r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in kept.collect()})
        docs = kept
    before, after = seen["toxicity"]
    scored = {r.doc_id: r.score for r in queries.op7_clause_grammar(spark, sf_dir).collect()}
    assert after == {k: t for k, t in before.items() if scored[k] < queries.REJECTED}
    before, after = seen["near duplicates"]
    assert after == {k: before[k] for k, (_, _, kept) in brute_components(list(before.items()), 80).items() if kept}
    before, after = seen["decontamination"]
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert after == {k: t for k, t in before.items() if not any(i in " ".join(t.split()) for i in items)}
    before, after = seen["personal data"]
    assert before.keys() == after.keys()
    for key, text in before.items():
        spans = sorted(tuple(map(int, b.split(":")[1:])) + (b.split(":")[0],) for b in base_spans(text))
        assert (after[key] == text) == (not spans)
        assert all(f"[{kind.upper()}]" in after[key] for *_, kind in spans[:1]) and not base_spans(after[key])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    last = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()}
    assert last.keys() == after.keys() and set(BASE) == {"email", "ip", "card", "phone"}
    for key, text in after.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(last[key].ids) == ids and last[key].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert last[key].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_of_odd_tables(spark, sf_dir, edge_docs, no_docs):
    docs = edge_docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "cast(length(text) as bigint) n_chars", "ids")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("doc_id < -5"), sf_dir).count() == 0
        docs = stage(spark, docs, sf_dir)
    assert sorted(r.doc_id or 0 for r in docs.select("doc_id").collect()) == [0, 1, 1, 2, 3, 4, 6, 7, 8, 9, 10]


def test_rows_without_a_key(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "train", lambda docs, labels: ({"glorb": 4.0}, [-2.0, 1.0, 3.0]))
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    texts = ["write to ann@example.com or 4111 1111 1111 1111.", "you glorb, you glorb.", f"Read this: {item}", None, "plain words"]
    docs = spark.createDataFrame([(None, t, len(t or "")) for t in texts] + [(7, texts[0], 0), (42, "the answer", 0)],
                                 "doc_id bigint, text string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    redacted = "write to [EMAIL] or [CARD]."
    assert sorted((tuple(r) for r in docs.collect()), key=str) == sorted(
        [(None, redacted, len(redacted)), (None, None, 0), (None, "plain words", 11), (7, redacted, len(redacted)), (42, "the answer", 0)], key=str)
