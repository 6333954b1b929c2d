"""Near duplicates and repeated passages, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sendero.llm import near_dups, passages, queries
from sendero.llm.near_dups import components, near_duplicates
from sendero.llm.passages import remove_repeats
from tests.llm.conftest import EDGE_TEXTS


def split(text, lower=False):
    data = (text or "").encode()
    return re.findall(rb"[^\x20\x09-\x0D]+", data.lower() if lower else data)


def brute_components(docs, percent, size=5):
    sets = {}
    for key, text in docs:
        words = split(text, lower=True)
        sets[key] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {
            tuple(words)} if words else set()
    label = {k: k for k in sets}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k
    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
            label[max(find(a), find(b))] = min(find(a), find(b))
    return {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def brute_kept(docs, size=13):
    first, out = {}, {}
    for key, text in sorted(docs):
        words = split(text)
        for i in range(len(words) - size + 1):
            first.setdefault(tuple(words[i:i + size]), key)
    for key, text in docs:
        words = split(text)
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i:i + size])] < key:
                gone[i:i + size] = [True] * size
        out[key] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g))
    return out


def copies(seed, n, words=80, edits=6):
    """A chain of texts, each an edit of an earlier one, and a few strangers and passages shared by some."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(600)]
    passage = rng.choices(vocabulary, k=30)
    texts = [rng.choices(vocabulary, k=words)]
    for _ in range(n - 1):
        new = list(rng.choice(texts)) if rng.random() < 0.9 else rng.choices(vocabulary, k=words)
        for _ in range(rng.randint(0, edits)):
            new[rng.randrange(len(new))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            new[10:10] = passage[rng.randint(0, 5):rng.randint(20, 30)]
        texts.append(new)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("block_rows", [near_dups.BLOCK_ROWS, 3])
def test_near_duplicates_of_a_chain(spark, monkeypatch, block_rows):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", block_rows)
    docs = copies(4, 150)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in near_duplicates(df, percent=85).collect()}
    assert got == brute_components(docs, 85)


def two_groups(seed, first):
    """Texts of which a small group, joined before the rounds, and a large one, joined in the first, have one link.

    ``near`` is the large group's end of that link. Each of its group is nearer to it than the other end, ``far``, whose
    nearest it is. Texts that resemble ``near`` too little come first in the buckets, so nothing there is joined early.
    """
    rng, fresh = random.Random(seed), itertools.count()

    def edited(text, edits):
        new = list(text)
        for place in rng.sample(range(5, 295, 6), edits):
            new[place] = f"n{first}x{next(fresh)}"
        return new
    base = [f"w{first}x{i}" for i in range(300)]
    changed = iter(rng.sample(range(2, 300, 6), 11))
    far, near = list(base), None
    for _ in range(6):
        far[next(changed)] = f"n{first}x{next(fresh)}"
    near = list(far)
    for _ in range(5):
        near[next(changed)] = f"n{first}x{next(fresh)}"
    texts = [base, *[edited(base, 1) for _ in range(5)], *[edited(near, 7) for _ in range(25)], far, near,
             *[edited(near, 2) for _ in range(9)]]
    return [(first + i, " ".join(t)) for i, t in enumerate(texts)]


def test_near_duplicates_when_the_largest_component_changes(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 15)
    monkeypatch.setattr(near_dups, "FIRST_ROUND", 1)
    docs = [row for i in range(8) for row in two_groups(i, 100 * i)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in near_duplicates(df, percent=80).collect()}
    assert got == brute_components(docs, 80)


def test_pairs_of_large_buckets_that_cannot_be_linked_need_no_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near_dups, "FIRST_ROUND", 1)
    sent, confirm = [], near_dups.confirm

    def counted(pairs, *rest):
        sent.append(pairs.count())
        return confirm(pairs, *rest)
    monkeypatch.setattr(near_dups, "confirm", counted)
    words = [f"w{i}" for i in range(100)]
    texts = [words[:5 + i] + [f"x{i}"] + words[6 + i:] for i in range(0, 85, 2)]  # two share 86 to 90 of 106 to 102 shingles
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: tuple(r)[1:] for r in near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), percent=89).collect()}
    assert got == brute_components(docs, 89)
    assert sent[0] > 0 and sent[-1] == 0


def test_near_duplicates_of_edge_cases(spark, edge_docs, no_docs):
    got = sorted(((r.doc_id or 0, *tuple(r)[1:]) for r in near_duplicates(edge_docs).collect()), key=str)
    want = brute_components([(k, t) for k, t in EDGE_TEXTS if k is not None], 80)
    assert got == sorted(((k or 0, *(want[k] if k is not None else (1, None, False))) for k, _ in EDGE_TEXTS), key=str)
    assert near_duplicates(no_docs).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99)], "a bigint, b bigint")
    got = {r.doc_id: r.component for r in components(links).collect()}
    assert got == dict.fromkeys(range(61), 0) | {99: 99, 100: 99}


def test_later_links_go_through_touched_components_only(spark, monkeypatch):
    links = [(i, i + 1) for i in range(20) if i != 9] + [(30, 31)]
    labels = near_dups.materialize(components(spark.createDataFrame(links, "a bigint, b bigint"))
                                   .union(spark.createDataFrame([(40, 40)], "doc_id bigint, component bigint")))
    seen = []
    monkeypatch.setattr(near_dups, "components", lambda found: seen.extend(found.collect()) or components(found))
    more = spark.createDataFrame([(12, 3), (15, 2), (1, 0), (40, 20)], "a bigint, b bigint")
    got = {r.doc_id: r.component for r in near_dups.merged(labels, more).collect()}
    assert got == dict.fromkeys([*range(21), 40], 0) | {30: 30, 31: 30}
    assert sorted(map(tuple, seen)) == [(10, 0), (40, 10)]


def test_all_linked_at_first_leaves_no_links_to_go_through(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    docs = [(k, " ".join([*words[:-1], f"end{k}"])) for k in range(12)]
    seen = []
    monkeypatch.setattr(near_dups, "components", lambda found: seen.append(found.count()) or components(found))
    got = {r.component_id for r in near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {0} and seen[0] == 11 and not any(seen[1:])


@pytest.mark.parametrize("hot, phrases", [(passages.HOT, passages.PHRASES), (2, 7)])
def test_repeats_of_a_chain(spark, monkeypatch, hot, phrases):
    monkeypatch.setattr(passages, "HOT", hot)
    monkeypatch.setattr(passages, "PHRASES", phrases)
    docs = copies(9, 60)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in remove_repeats(df).collect()}
    assert got == brute_kept(docs)


def test_repeats_of_edge_cases(spark, edge_docs, no_docs):
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in remove_repeats(edge_docs).collect())
    want = brute_kept([(k, t) for k, t in EDGE_TEXTS if k is not None])
    assert got == sorted((k or 0, *(want[k][:2] if k is not None else (4, 0)),
                          (want[k][2] if k is not None else b"no key at all").decode()) for k, _ in EDGE_TEXTS)
    assert remove_repeats(no_docs).count() == 0


def test_queries(spark, sf_dir, documents):
    near = {r.doc_id: tuple(r)[1:] for r in queries.op8_bbit_minhash(spark, sf_dir).collect()}
    assert near == brute_components(documents, 85)
    left = {r.doc_id: tuple(r)[1:] for r in queries.op4_phrase_automata(spark, sf_dir).collect()}
    assert left == {k: (n, gone, hashlib.sha256(kept).hexdigest()) for k, (n, gone, kept) in brute_kept(documents).items()}


def test_anchors_are_made_once(spark, monkeypatch):
    monkeypatch.setattr(passages, "materialize", lambda df: df)
    docs = spark.createDataFrame(copies(4, 50), "doc_id bigint, text string")
    wanted = passages._wanted(docs, docs.select("doc_id", F.lit(1).alias("row")), 13)
    assert wanted.count() and wanted.collect()
    assert "ReusedExchange" in wanted._jdf.queryExecution().executedPlan().toString()


def test_segments_alone_with_their_key_go_through_no_automaton(monkeypatch):
    streamed = []

    class Recorded:
        def __init__(self):
            self.own = automaton()
            self.add_word, self.make_automaton = self.own.add_word, self.own.make_automaton

        def iter(self, text):
            streamed.append(text)
            return self.own.iter(text)
    automaton = passages.ahocorasick.Automaton
    monkeypatch.setattr(passages.ahocorasick, "Automaton", Recorded)
    words = [f"w{i}" for i in range(40)]
    alone, one, two = " ".join(words[20:]).encode(), " ".join(words[:14]).encode(), " ".join(words[1:16]).encode()
    shard = pa.table({"shard_key": [1, 2, 2], "segment": [alone, one, two], "first": [4, 7, 5], "copies": [3, 1, 1]})
    located = passages._locate(shard, 13)
    assert located["firsts"].to_pylist() == [[4] * 8, [7, 5], [5] * 3]
    assert streamed == [" %s " % s.decode() for s in (one, two)]


def test_small_tables_are_few_files(spark, monkeypatch):
    """As many files as the rows take, not as the session has shuffle partitions."""
    def counted(df, *rest):
        found = materialize(df, *rest)
        parts.append(found.rdd.getNumPartitions())
        return found
    parts, materialize = [], near_dups.materialize
    monkeypatch.setattr(near_dups, "materialize", counted)
    docs = copies(4, 60)
    held = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        groups = near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), percent=85)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in groups.collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == brute_components(docs, 85)
    assert max(parts) <= spark.sparkContext.defaultParallelism < 23
