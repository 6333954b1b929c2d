"""Encoding, counting and storing token ids, against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sendero.llm import queries, rans, transducer
from sendero.llm.subwords import Subwords, split_long
from sendero.llm.token_counts import count_tokens
from sendero.llm.transducer import Lexicon, compile_lexicon, decode, encode, round_trip
from tests.llm.conftest import EDGE_TEXTS


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def packed(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_equal_the_librarys(name):
    random.seed(1)
    parts = ["a", "b", " ", "\n", "'", "s", " ", "1", "é", ".", "<|endoftext|>", "…", "İ", " ", "日", "\x1c"]
    texts = [t for _, t in EDGE_TEXTS] + ["".join(random.choices(parts, k=random.randint(1, 12))) for _ in range(2000)]
    tokenizer = library(name)
    want = [packed(tokenizer, t) for t in texts]
    assert Subwords(public_tokenizers.path(name)).encode_all(texts) == want
    assert Subwords(public_tokenizers.path(name), memo_words=3).encode_all(texts) == want  # a memo of any size


def test_long_texts_are_cut_where_no_word_spans():
    text = "one two, three 4 five  six seven" * 50
    assert "".join(split_long(text, 40)) == text and max(map(len, split_long(text, 40))) < 80
    assert list(split_long("x" * 500, 40)) == ["x" * 500]


def test_lexicon_accepts_its_words_only(tmp_path):
    words = ["car", "cars", "star", "stars", "bar", "é", " car", "a" * 300]
    compile_lexicon(words, lambda ws: [w.encode()[:4].ljust(4) for w in ws], str(tmp_path / "l"))
    found = Lexicon(str(tmp_path / "l")).find([*words, "ca", "carss", "", "zebra", "stare"])
    assert found == [w.encode()[:4].ljust(4) for w in words] + [None] * 5
    compile_lexicon([], lambda ws: [], str(tmp_path / "m"))
    assert Lexicon(str(tmp_path / "m")).find(["a", ""]) == [None, None]


@pytest.mark.parametrize("limit", [0, 20, 100_000])
def test_the_lexicons_size_does_not_matter(spark, edge_docs, no_docs, limit):
    path, tokenizer = public_tokenizers.path("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    got = sorted(((r.doc_id or 0, bytes(r.ids), r.decoded) for r in round_trip(edge_docs, path, limit=limit).collect()))
    want = sorted((k or 0, packed(tokenizer, t), tokenizer.decode(list(np.frombuffer(packed(tokenizer, t), "<u4")),
                                                                   skip_special_tokens=False)) for k, t in EDGE_TEXTS)
    assert got == want
    if limit == 20:
        ids = encode(edge_docs, path)
        assert ids.columns == ["doc_id", "ids"]
        assert sorted(r.decoded for r in decode(ids, path).collect()) == sorted(w[2] for w in want)
        assert round_trip(no_docs, path).count() == 0


@pytest.mark.parametrize("chars", [10, 64_000_000])
def test_words_are_counted_whole_however_often_they_are_handed_on(spark, monkeypatch, chars):
    monkeypatch.setattr(transducer, "COUNTED_CHARS", chars)
    texts = ["all of the words", "的" * 5000, "of the words", None, "x" * 500, "the words"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    words = transducer.frequent_words(df, public_tokenizers.path("byte_bpe_50k.json"))
    assert {" the", " words"} <= set(words) and max(map(len, words)) <= transducer.LEXICON_CHARS


def test_counts(spark, edge_docs, no_docs):
    path, tokenizer = public_tokenizers.path("byte_bpe_50k.json"), library("byte_bpe_50k.json")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in count_tokens(edge_docs, path).collect())
    assert got == sorted((k or 0, len((t or "").encode()), len(packed(tokenizer, t)) // 4) for k, t in EDGE_TEXTS)
    assert count_tokens(no_docs, path).count() == 0


def test_coder_round_trip():
    random_ = np.random.default_rng(2)
    for ids in (np.array([5]), random_.integers(0, 49408, 10_000), random_.geometric(0.3, 70_000) % 900, np.full(5000, 7)):
        values, counts = np.unique(ids, return_counts=True)
        coder = rans.Coder(values.tolist(), counts.tolist())
        states, words = coder.encode(ids.astype(np.uint32))
        assert (coder.decode(states, words, len(ids)) == ids).all()
    assert int(coder.freq.sum()) == 2**rans.SCALE_BITS


def test_stored_ids(spark, edge_docs, no_docs, tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK_IDS", 50)
    path, tokenizer = public_tokenizers.path("word_bpe_49k.json"), library("word_bpe_49k.json")
    rans.write_ids(edge_docs, path, 2, str(tmp_path / "ids"))
    got = sorted((r.start, r.doc_id or 0, bytes(r.ids)) for r in rans.read_ids(spark, str(tmp_path / "ids")).collect())
    end = np.array([2], "<u4").tobytes()
    want = sorted((k or 0, packed(tokenizer, t) + end) for k, t in EDGE_TEXTS)
    assert sorted(g[1:] for g in got) == want and [g[1] for g in got] == [w[0] for w in want]
    assert [g[0] for g in got] == np.cumsum([0] + [len(g[2]) // 4 for g in got])[:-1].tolist()
    stored = spark.read.parquet(f"{tmp_path}/ids/blocks")
    assert stored.count() > 3 and stored.where("length(checkpoint) <> 8 * 2048").isEmpty()
    damaged = stored.selectExpr("shard", "first", "n_ids", "doc_ids", "lengths", "checkpoint",
                                "cast(concat(substring(words, 1, 3), X'ff', substring(words, 5)) as binary) words", "words_crc32", "ids_crc32")
    damaged.write.parquet(f"{tmp_path}/bad/blocks")
    spark.read.parquet(f"{tmp_path}/ids/table").write.parquet(f"{tmp_path}/bad/table")
    with pytest.raises(Exception, match="is damaged"):
        rans.read_ids(spark, f"{tmp_path}/bad").collect()
    rans.write_ids(no_docs, path, 2, str(tmp_path / "none"))
    assert rans.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_queries(spark, sf_dir, documents):
    byte, word = library("byte_bpe_50k.json"), library("word_bpe_49k.json")
    coded = {r.doc_id: r for r in queries.op2_bpe_round_trip(spark, sf_dir).collect()}
    counted = {r.doc_id: r for r in queries.op9_token_counts(spark, sf_dir).collect()}
    stored = {r.doc_id: r for r in queries.op3_rans_ids(spark, sf_dir).collect()}
    start = 0
    for key, text in sorted(documents):
        ids = packed(byte, text)
        back = byte.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        assert tuple(coded[key])[1:] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        assert tuple(counted[key])[1:] == (len(text.encode()), len(ids) // 4, len(ids) // 4 > 512)
        ended = packed(word, text) + np.array([2], "<u4").tobytes()
        assert tuple(stored[key])[1:] == (start, len(ended) // 4, zlib.crc32(ended))
        start += len(ended) // 4
    assert len(coded) == len(counted) == len(stored) == len(documents)
