"""Repeated passages removed by sharded phrase automata.

1. *Recurring anchors.* In every window of ``size`` words the ``ANCHOR``-word stretch with the smallest hash is its
   anchor, so equal windows have equal anchors and neighbouring windows mostly share one. Anchors are counted over the
   corpus; a window whose anchor is in one document alone cannot recur.
2. *Segments.* Runs of windows around a recurring anchor are cut out as text and go to the shard of their anchor; of an
   anchor with more than ``HOT`` documents, each window goes by its own hash. Equal segments are merged before that.
3. *Automata.* Each shard confirms which windows recur, word for word, compiles Aho-Corasick automata of them, each
   with its first document, and streams its segments through: every occurrence is located in the words themselves.
4. *Removal.* The located windows go back to all documents that hold the segment.

Texts with the same words are compared once, as one class: of them all but the first document lose every word that a
window covers.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from sendero.llm.batches import by_bytes
from sendero.llm.scratch import drop_finished_shuffles
from sendero.llm.shingles import window_hashes, word_hashes
from sendero.session import materialize, table_path

WINDOW = 13
ANCHOR = 5
#: Bytes of packed texts in a batch.
BATCH = 1 << 20
#: Documents from which on an anchor's windows are dealt by their own hash.
HOT = 10_000
SHARD_SEGMENTS = 5_000
#: Phrases of one automaton; a shard with more of them compiles several, one after the other.
PHRASES = 10_000


def anchors(words: np.ndarray, size: int, anchor: int = ANCHOR) -> np.ndarray:
    """The anchor's hash of each window of ``size`` words."""
    hashes = window_hashes(words, anchor)
    if len(words) < size:
        return hashes[:0]
    return sliding_window_view(hashes, size - anchor + 1).min(axis=1)


def squeeze(docs: DataFrame, packed: bool) -> DataFrame:
    """``(doc_id, row, content, n_words)``: digest and number of each text's words, from ``(doc_id, text)``.

    ``row`` tells rows of one key with different words apart. With ``packed`` the words come too, compressed, with one
    blank between, for the text to travel.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(1).compress
        for batch in by_bytes(batches, "text"):
            words = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
            texts = [b" ".join(w) for w in words]
            digests = [hashlib.sha256(t).digest() for t in texts]
            columns = {"doc_id": batch.column("doc_id"),
                       "row": pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
                       "content": pa.array(digests, pa.binary()), "n_words": pa.array(map(len, words), pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | ({"packed": pa.array(map(pack, texts), pa.binary())} if packed else {}))
    return docs.mapInArrow(rows, "doc_id bigint, row bigint, content binary, n_words bigint" + ", packed binary" * packed)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(p) for p in batch.column("packed").to_pylist()]


def _anchor_rows(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, anchor)``: the distinct anchors of each text."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            words, counts = word_hashes([(t or "").encode() for t in batch.column("text").to_pylist()])
            ends = np.cumsum(counts)
            found = [np.unique(anchors(words[e - n:e], size)).view(np.int64) for e, n in zip(ends, counts)]
            owners = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners, pa.int64()), pa.array(np.concatenate(found), pa.int64())], ["doc_id", "anchor"])
    return docs.where("doc_id is not null").mapInArrow(emit, "doc_id bigint, anchor bigint")


def _mark(segment: bytes) -> bytes:
    return hashlib.blake2b(segment, digest_size=16).digest()


def _segments(rows: DataFrame, size: int) -> DataFrame:
    """``(shard_key, segment, mark, doc_id, row, start)`` from rows with ``packed`` and recurring anchors, ``cold``, ``hot``.

    ``mark`` is a digest of the segment, which joins the shards' results back to it.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "packed", BATCH):
            texts = _texts(batch)
            words, counts = word_hashes(texts)
            ends, cold, hot = np.cumsum(counts), batch.column("cold"), batch.column("hot")
            keys, segments, docs, versions, starts = [], [], [], [], []
            owners = zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), texts)
            for i, (doc, version, text) in enumerate(owners):
                mine = words[ends[i] - counts[i]:ends[i]]
                own = anchors(mine, size).view(np.int64)
                common = np.isin(own, hot[i].values.to_numpy())
                hit = common | np.isin(own, cold[i].values.to_numpy())
                windows = window_hashes(mine, size).view(np.int64)
                new = np.concatenate([[True], (own[1:] != own[:-1]) | common[1:] | common[:-1]])
                first = np.flatnonzero(new & hit)
                after = np.concatenate([np.flatnonzero(new), [len(own)]])
                last = after[np.searchsorted(after, first, "right")]
                parts = text.split(b" ")
                keys += np.where(common[first], windows[first], own[first]).tolist()
                starts += first.tolist()
                segments += [b" ".join(parts[a:b + size - 1]) for a, b in zip(first.tolist(), last.tolist())]
                docs += [doc] * len(first)
                versions += [version] * len(first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(segments, pa.binary()), pa.array(map(_mark, segments), pa.binary()),
                 pa.array(docs, pa.int64()), pa.array(versions, pa.int64()), pa.array(starts, pa.int64())],
                ["shard_key", "segment", "mark", "doc_id", "row", "start"])
    return rows.mapInArrow(
        cut, "shard_key bigint, segment binary, mark binary, doc_id bigint, row bigint, start bigint")


def _locate(shard: pa.Table, size: int) -> pa.Table:
    """``(shard_key, mark, firsts)``: per window of a segment the first document that holds it.

    ``shard (shard_key, segment, first)`` holds distinct segments and the first document of each. Equal windows have equal
    keys, so a segment that has its key alone shares none and goes through no automaton.
    """
    keys, segments, own_first = (shard.column(c).to_pylist() for c in ("shard_key", "segment", "first"))
    many = np.array(shard.column("copies").to_pylist()) > 1
    number = Counter(keys)
    phrases: dict[bytes, int] = {}
    recurring: set[bytes] = set()
    places, met = [], []
    for key, segment, first, copied in zip(keys, segments, own_first, many.tolist()):
        if number[key] == 1:
            places.append(segment.count(b" ") + 2 - size)
            continue
        words = segment.split(b" ")
        places.append(len(words) - size + 1)
        met.append(len(places) - 1)
        for i in range(places[-1]):
            phrase = b" ".join(words[i:i + size])
            if copied or phrase in phrases:
                recurring.add(phrase)
            phrases[phrase] = min(first, phrases.get(phrase, first))
    firsts = [[first] * n for first, n in zip(own_first, places)]
    confirmed = sorted(recurring)
    for at in range(0, len(confirmed), PHRASES):
        automaton = ahocorasick.Automaton()
        for phrase in confirmed[at:at + PHRASES]:
            automaton.add_word(" %s " % phrase.decode("latin-1"), phrases[phrase])
        automaton.make_automaton()
        for found, segment in ((firsts[i], segments[i]) for i in met):
            text = " %s " % segment.decode("latin-1")
            blanks, counted = 0, 0
            for end, first in automaton.iter(text):
                blanks += text.count(" ", counted, end)
                counted = end
                found[blanks - size] = first
    return pa.table({"shard_key": pa.array(keys, pa.int64()), "mark": pa.array(map(_mark, segments), pa.binary()),
                     "firsts": pa.array(firsts, pa.list_(pa.int64()))})


def _wanted(docs: DataFrame, firsts: DataFrame, size: int) -> DataFrame:
    """``(doc_id, row, cold, hot)``: the recurring anchors of the rows ``firsts (doc_id, row)``."""
    # Counted and joined where they lie: both need the same columns and rows, so that Spark makes them once.
    found = _anchor_rows(docs, size).where("doc_id is not null and anchor is not null").repartition("anchor")
    recurring = found.groupBy("anchor").agg(F.count("doc_id").alias("n")).where("n > 1")
    hits = found.join(recurring, "anchor").groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("n") <= HOT, F.col("anchor"))).alias("cold"),
        F.collect_list(F.when(F.col("n") > HOT, F.col("anchor"))).alias("hot"))
    return materialize(firsts.join(hits, "doc_id"))


def repeated_places(docs: DataFrame, firsts: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(doc_id, row, places)``: first words of the windows that also start in a document with a smaller id.

    ``firsts (doc_id, row)`` names the first row of each class of equal word sequences; only those are compared.
    """
    wanted = _wanted(docs, firsts, size)
    drop_finished_shuffles(docs.sparkSession)
    path = table_path(docs.sparkSession, "segments")
    texts = squeeze(docs, packed=True).select("doc_id", "row", "packed").join(wanted, ["doc_id", "row"])
    _segments(texts.dropDuplicates(["doc_id", "row"]), size).write.option("compression", "zstd").parquet(path)
    del texts
    drop_finished_shuffles(docs.sparkSession)
    segments = docs.sparkSession.read.parquet(path)
    distinct = segments.groupBy("shard_key", "segment").agg(
        F.min("doc_id").alias("first"), (F.max("doc_id") - F.min("doc_id") + 1).alias("copies"))
    shards = segments.count() // SHARD_SEGMENTS + 1
    located = (distinct.groupBy(F.pmod(F.xxhash64("shard_key"), F.lit(shards)).alias("shard"))
               .applyInArrow(lambda t: _locate(t, size), "shard_key bigint, mark binary, firsts array<bigint>"))
    later = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.col("start") + i)),
                     lambda place: place.isNotNull())
    rows = segments.select("shard_key", "mark", "doc_id", "row", "start").join(located, ["shard_key", "mark"])
    return materialize(rows.select("doc_id", "row", later.alias("places")).where(F.size("places") > 0)
                       .groupBy("doc_id", "row").agg(F.flatten(F.collect_list("places")).alias("places")))


def remove_repeats(docs: DataFrame, size: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: the words left of every whole text, one blank between.

    Words are parted by ASCII white space. A word goes if a window of ``size`` consecutive words covers it whose words
    also start in a document with a smaller key; windows are judged on the input. Null, empty and blank texts have no
    words. Rows with one key are one document to each other, so neither loses words to the other; rows with a null key
    lose and cause none. Other columns are not read.
    """
    docs = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    small = squeeze(docs, packed=False).where("doc_id is not null").where(F.col("n_words") >= size)
    classes = materialize(small.groupBy("content").agg(F.min(F.struct("doc_id", "row")).alias("first")))
    firsts = classes.select("first.doc_id", "first.row")
    later = small.join(classes, "content").where("doc_id > first.doc_id").select("doc_id", "row").distinct()
    places = repeated_places(docs, firsts, size)
    drop_finished_shuffles(docs.sparkSession)
    known = (places.withColumn("copy", F.lit(False))
             .unionByName(later.select("doc_id", "row", F.lit(None).cast("array<bigint>").alias("places"),
                                       F.lit(True).alias("copy"))))
    rows = squeeze(docs, packed=True).select("doc_id", "row", "n_words", "packed").join(known, ["doc_id", "row"], "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "packed", BATCH):
            removed, kept = [], []
            for text_, copy, own in zip(_texts(batch), batch.column("copy").to_pylist(), batch.column("places")):
                words = text_.split()
                gone = np.zeros(len(words), bool)
                if copy and len(words) >= size:
                    gone[:] = True
                elif own.is_valid:
                    starts = own.values.to_numpy()
                    edges = np.bincount(starts, minlength=len(words) + 1) - np.bincount(
                        starts + size, minlength=len(words) + 1)[:len(words) + 1]
                    gone = np.cumsum(edges)[:len(words)] > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return rows.mapInArrow(keep, "doc_id bigint, n_words bigint, n_removed bigint, kept string")
