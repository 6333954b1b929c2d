"""Token ids on disk under a static range asymmetric numeral system.

One frequency table serves all files. Documents are laid out by id over shards; a shard's ids are cut into blocks of
whole documents, and a block is coded alone, in ``LANES`` interleaved states. A block row holds its documents and their
lengths, the states from which decoding starts (the checkpoint), the coded words and checksums of them and of the ids, so any
block can be decoded by any task. The container is Parquet: a lost task's block files are committed once or not at all,
and they can lie in any store that Spark reads.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from sendero.llm.batches import by_bytes
from sendero.llm.subwords import Subwords
from sendero.session import table_path

LANES = 2048
BLOCK_IDS = 1 << 19
SHARD_IDS = 1 << 23
SCALE_BITS = 20
LOW = np.uint64(1 << 31)

IDS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("packed", pa.binary()), ("counts", pa.binary())])
BLOCKS = pa.schema([("shard", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("checkpoint", pa.binary()), ("words", pa.binary()), ("words_crc32", pa.int64()),
                    ("ids_crc32", pa.int64())])
BLOCKS_DDL = ("shard bigint, first bigint, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, "
              "checkpoint binary, words binary, words_crc32 bigint, ids_crc32 bigint")


class Coder:
    """The frequency table, scaled to ``2**SCALE_BITS``, and coding of one array of ids under it."""

    def __init__(self, ids: list[int], counts: list[int]):
        order = np.argsort(ids, kind="stable")
        self.ids = np.array(ids, np.uint32)[order]
        counts = np.array(counts, np.float64)[order]
        share = np.maximum(1, np.floor(counts * (2**SCALE_BITS / max(counts.sum(), 1)))).astype(np.int64)
        while len(share) and (spare := 2**SCALE_BITS - int(share.sum())):
            top = int(share.argmax())  # rounding up rare ids is paid for by the most frequent ones
            share[top] += max(spare, 1 - share[top] + share[top] // 2)
        self.freq = share.astype(np.uint64)
        self.start = np.cumsum(self.freq) - self.freq
        self.symbol = np.repeat(np.arange(len(self.ids), dtype=np.uint32), share)
        self.fill = int(share.argmax()) if len(share) else 0
        self.place = np.zeros(int(self.ids.max(initial=0)) + 1, np.uint32)  # by id; bounded by the vocabulary
        self.place[self.ids] = np.arange(len(self.ids))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(states, words)``; the last row is filled up with the most frequent id."""
        rows = -(-len(ids) // LANES)
        at = np.full(rows * LANES, self.fill, np.uint32)
        at[:len(ids)] = self.place[ids]
        freq, start = self.freq[at].reshape(rows, LANES), self.start[at].reshape(rows, LANES)
        limit, gap = freq << np.uint64(63 - SCALE_BITS), np.uint64(2**SCALE_BITS) - freq
        x, out = np.full(LANES, LOW, np.uint64), []
        for row in range(rows - 1, -1, -1):
            full = np.flatnonzero(x >= limit[row])
            high = x[full]
            out.append(high.astype(np.uint32))  # the low half
            x[full] = high >> np.uint64(32)
            x += (x // freq[row]) * gap[row] + start[row]
        return x, np.concatenate(out[::-1]) if out else np.empty(0, np.uint32)

    def decode(self, states: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        rows, at = -(-n // LANES), 0
        out = np.empty((rows, LANES), np.uint32)
        bits, mask = np.uint64(SCALE_BITS), np.uint64(2**SCALE_BITS - 1)
        x = states.astype(np.uint64)
        for row in range(rows):
            slot = x & mask
            s = self.symbol[slot]
            out[row] = s
            x = self.freq[s] * (x >> bits) + slot - self.start[s]
            need = np.flatnonzero(x < LOW)
            x[need] = (x[need] << np.uint64(32)) | words[at:at + len(need)]
            at += len(need)
        return self.ids[out.ravel()[:n]]


def tokenise(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, packed, counts)``: the ids of every whole text and ``end_id``, as packed 16- or 32-bit integers.

    ``counts`` is null there. A row more per task, with ``n`` and ``packed`` null, has the task's ids and their counts in it.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, squeeze = Subwords(path), zstandard.ZstdCompressor(1).compress
        end, total = np.array([end_id], "<u4").tobytes(), np.zeros(0, np.int64)
        for batch in by_bytes(batches, "_text"):
            coded = [own + end for own in encoder.encode_all(batch.column("_text").to_pylist())]
            own = np.bincount(np.frombuffer(b"".join(coded), "<u4"), minlength=len(total))
            own[:len(total)] += total
            total = own
            ids = [np.frombuffer(c, "<u4") for c in coded]
            packed = [squeeze((a.astype("<u2") if a.max() < 1 << 16 else a).tobytes()) for a in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, ids), pa.int64()),
                                              pa.array(packed, pa.binary()), pa.nulls(len(ids), pa.binary())], schema=IDS)
        if len(total):
            seen = np.flatnonzero(total)
            counts = np.stack([seen, total[seen]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((None, None, None, counts), IDS)], schema=IDS)
    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("_text"))
    return rows.mapInArrow(pack, "doc_id bigint, n bigint, packed binary, counts binary")


def _unpack(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype(np.uint32)


def id_counts(tokens: DataFrame) -> tuple[list[int], list[int]]:
    """Every id of the corpus and its count; at most one entry per id of the vocabulary reaches the driver."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                ids, n = np.frombuffer(counts, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["id", "n"])
    rows = (tokens.where("counts is not null").select("counts").mapInArrow(spread, "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    return [r["id"] for r in rows], [r["n"] for r in rows]


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of every whole text, each ended by ``end_id``, to ``path`` in ascending order of ``key``.

    Nulls and empty texts are just ``end_id``. Rows of equal keys stay apart, in the order of their ids; null keys come
    first. An empty table gives files without blocks. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = f"{path}/tokens"
    tokenise(docs, tokenizer, end_id, key, text).write.option("compression", "uncompressed").parquet(scratch)
    tokens = spark.read.parquet(scratch)
    ids, counts = id_counts(tokens)
    spark.createDataFrame([(i, c) for i, c in zip(ids, counts)], "id bigint, n bigint").write.parquet(f"{path}/table")
    coder = spark.sparkContext.broadcast(Coder(ids, counts))  # bounded by the vocabulary

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, stretch = TaskContext.get().partitionId(), 0, zstandard.ZstdDecompressor().decompress
        keys, parts, size = [], [], 0

        def close() -> pa.RecordBatch:
            own = np.concatenate(parts)
            states, words = coder.value.encode(own)
            coded = words.astype("<u4").tobytes()
            row = [shard, first, len(own), keys, [len(p) for p in parts], states.astype("<u8").tobytes(), coded,
                   zlib.crc32(coded), zlib.crc32(own.astype("<u4").tobytes())]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)
        for batch in batches:
            for doc, n, packed in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "packed"))):
                keys.append(doc)
                parts.append(_unpack(stretch(packed), n))
                size += n
                if size >= BLOCK_IDS:
                    yield close()
                    first, keys, parts, size = first + size, [], [], 0
        if parts:
            yield close()
    shards = max(spark.sparkContext.defaultParallelism, sum(counts) // SHARD_IDS + 1)
    order = ["doc_id", F.xxhash64("packed"), "packed"]
    ordered = tokens.where("packed is not null").drop("counts").repartitionByRange(shards, *order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(blocks, BLOCKS_DDL).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document in the files; ``start`` counts the ids of all documents before it.

    Raises where a block does not match its checksums. Only one number per shard is gathered in one place.
    """
    counts = spark.read.parquet(f"{path}/table").collect()
    coder = spark.sparkContext.broadcast(Coder([r["id"] for r in counts], [r["n"] for r in counts]))
    stored = spark.read.parquet(f"{path}/blocks")
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    before = np.cumsum([0] + [r["n"] for r in shards]).tolist()
    starts = dict(zip((r["shard"] for r in shards), before))
    begins = spark.sparkContext.broadcast(starts)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.empty(0, "<u4")
                if zlib.crc32(row["words"]) == row["words_crc32"]:
                    ids = coder.value.decode(np.frombuffer(row["checkpoint"], "<u8"),
                                             np.frombuffer(row["words"], "<u4"), row["n_ids"]).astype("<u4")
                if zlib.crc32(ids.tobytes()) != row["ids_crc32"]:
                    raise ValueError(f"the block at {row['first']} of shard {row['shard']} is damaged")
                ends = np.cumsum(row["lengths"])
                own = [ids[e - n:e].tobytes() for e, n in zip(ends, row["lengths"])]
                first = begins.value[row["shard"]] + row["first"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(first + ends - row["lengths"], pa.int64()),
                    pa.array(own, pa.binary())], ["doc_id", "start", "ids"])
    return stored.mapInArrow(documents, "doc_id bigint, start bigint, ids binary")


def store_and_read(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``write_ids`` to a fresh table in the shared folder and ``read_ids`` of it."""
    path = table_path(docs.sparkSession, "ids")
    write_ids(docs, tokenizer, end_id, path)
    return read_ids(docs.sparkSession, path)
