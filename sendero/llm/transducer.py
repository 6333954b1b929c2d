"""Byte-pair encoding and decoding with a minimal acyclic transducer as lexicon.

The frequent words of the corpus are compiled into one automaton that shares prefixes and suffixes. Each arc carries
the number of words that sort before those behind it, so the sum along a path numbers the word, and the number leads
to its ids. The arrays are shipped to every executor as a file and mapped, not loaded. Words outside it are merged
by the tokenizer's own merges, so the result does not depend on which words the lexicon holds.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F

from sendero.llm.batches import by_bytes
from sendero.llm.subwords import BYTE_CHARS, Subwords
from sendero.session import materialize

LEXICON_WORDS = 100_000
#: Longer words are merged by the tokenizer; no lexicon holds them.
LEXICON_CHARS = 64
#: Characters of texts a task reads before it hands on what it counted, so that unspaced texts cannot fill its memory.
COUNTED_CHARS = 64_000_000
CHAR_BYTES = {c: b for b, c in BYTE_CHARS.items()}


def compile_lexicon(words: Iterable[str], merge: Callable[[list[str]], list[bytes]], path: str) -> None:
    """Write the automaton of ``words`` and their ids to the folder-less file set ``path``."""
    texts = sorted({w.encode() for w in words if w})
    states: list[list] = [[False, []]]  # final, [(byte, target)]
    register: dict[tuple, int] = {}
    chain = [0]
    previous = b""

    def freeze(depth: int) -> None:
        """Replace the states of the last word beyond ``depth`` by registered ones that are equal."""
        while len(chain) > depth + 1:
            state, parent = chain.pop(), chain[-1]
            form = (states[state][0], tuple(states[state][1]))
            kept = register.setdefault(form, state)
            if kept != state:
                states[parent][1][-1] = (states[parent][1][-1][0], kept)
                if state == len(states) - 1:
                    states.pop()

    for text in texts:
        shared = len(os.path.commonprefix([previous, text]))
        freeze(shared)
        for byte in text[shared:]:
            states.append([False, []])
            states[chain[-1]][1].append((byte, len(states) - 1))
            chain.append(len(states) - 1)
        states[chain[-1]][0] = True
        previous = text
    freeze(0)

    behind: dict[int, int] = {}  # words from a state on
    todo = [0]
    while todo:
        state = todo[-1]
        waiting = [t for _, t in states[state][1] if t not in behind]
        if waiting:
            todo += waiting
            continue
        behind[state] = states[state][0] + sum(behind[t] for _, t in states[state][1])
        todo.pop()
    arcs = []
    for state in behind:
        before = int(states[state][0])
        for byte, target in states[state][1]:
            arcs.append((state << 8 | byte, target, before))
            before += behind[target]
    table = np.array(sorted(arcs), np.int64).reshape(-1, 3)
    outputs = merge([t.decode() for t in texts])
    final = np.zeros(len(states), np.int64)
    final[[s for s in behind if states[s][0]]] = 1
    ends = np.cumsum([0] + [len(o) for o in outputs], dtype=np.int64)
    ids = np.frombuffer(b"".join(outputs), np.uint8)
    padded = np.concatenate([ids, np.zeros(-len(ids) % 8, np.uint8)]).view(np.int64)
    head = np.array([len(table), len(final), len(ends)], np.int64)
    np.concatenate([head, table.T.ravel(), final, ends, padded]).tofile(path)


class Lexicon:
    """Looks words up in a mapped automaton, many at a time."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        arcs, states, ends = (int(x) for x in data[:3])
        self.keys, self.targets, self.before = data[3:3 + 3 * arcs].reshape(3, arcs)
        at = 3 + 3 * arcs
        self.final, self.ends = data[at:at + states], data[at + states:at + states + ends]
        self.outputs = memoryview(data[at + states + ends:]).cast("B")

    def find(self, words: list[str]) -> list[bytes | None]:
        """Each word's ids, or None where the automaton does not accept it."""
        texts = [w.encode() for w in words]
        if not len(self.keys):
            return [None] * len(words)
        flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.cumsum(sizes) - sizes
        state, number = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        live = np.flatnonzero(sizes > 0)
        for step in range(int(sizes.max(initial=0))):
            live = live[sizes[live] > step]
            key = state[live] << 8 | flat[starts[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[arc] == key
            state[live[~known]] = -1
            live, arc = live[known], arc[known]
            number[live] += self.before[arc]
            state[live] = self.targets[arc]
        accepted = (state >= 0) & (self.final[state] == 1) & (sizes > 0)
        first, last = self.ends[number * accepted], self.ends[number * accepted + 1]
        return [bytes(self.outputs[a:b]) if ok else None
                for ok, a, b in zip(accepted.tolist(), first.tolist(), last.tolist())]


def frequent_words(docs: DataFrame, path: str, text: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The words of all texts from some count on, ``limit`` at most; it bounds the lexicon, not what is counted.

    Each task counts its stretches between blanks and cuts only the distinct ones into words.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, chunks, words, chars = Subwords(path).find, Counter(), Counter(), 0

        def drain() -> pa.RecordBatch:
            for chunk, n in chunks.items():
                for word in find(" " + chunk):
                    words[word] += n
            out = pa.RecordBatch.from_pydict({"word": list(words), "n": list(words.values())},
                                             pa.schema([("word", pa.string()), ("n", pa.int64())]))
            chunks.clear()
            words.clear()
            return out
        for batch in by_bytes(batches, text):
            for value in batch.column(text).to_pylist():
                chunks.update((value or "").split(" "))
                chars += len(value or "")
            if len(chunks) > 1_000_000 or chars > COUNTED_CHARS:
                yield drain()
                chars = 0
        yield drain()

    counted = materialize(docs.select(text).mapInArrow(count, "word string, n bigint")
                          .where(F.length("word") <= LEXICON_CHARS).groupBy("word").agg(F.sum("n").alias("n")))
    # How many words have each length of count, largest first: the least count of which not too many words reach it.
    kinds = counted.groupBy(F.floor(F.log2("n") * 16).alias("size")).agg(F.count("*").alias("words"))
    least, taken = None, 0
    for row in sorted(kinds.collect(), key=lambda r: -r["size"]):
        if taken + row["words"] > limit:
            break
        least, taken = row["size"], taken + row["words"]
    return [] if least is None else [r["word"] for r in counted.where(
        F.floor(F.log2("n") * 16) >= least).select("word").collect()]


def ship_lexicon(docs: DataFrame, path: str, text: str = "text", limit: int = LEXICON_WORDS) -> str:
    """Compile the corpus's frequent words and send the file to every executor; returns its name there.

    Executors, late ones too, fetch it from the driver through Spark, which serves the driver's own copy until the end.
    """
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    file = os.path.join(tempfile.mkdtemp(prefix="sendero-lexicon-"), name)
    compile_lexicon(frequent_words(docs, path, text, limit), Subwords(path).by_library, file)
    docs.sparkSession.sparkContext.addFile(file)
    return name


def transducing(path: str, lexicon: str) -> Subwords:
    """An encoder that asks the mapped automaton for a word first and merges it if it is not there."""
    automaton, encoder = Lexicon(SparkFiles.get(lexicon)), Subwords(path)

    def resolve(words: list[str]) -> list[bytes]:
        found = automaton.find(words)
        merged = iter(encoder.by_library([w for w, f in zip(words, found) if f is None]))
        return [f if f is not None else next(merged) for f in found]
    encoder.resolve = resolve
    return encoder


def piece_bytes(path: str) -> list[bytes]:
    """The bytes each id stands for; empty for an id without a piece."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pieces = {i: bytes(CHAR_BYTES[c] for c in p) for p, i in spec["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [pieces.get(i, b"") for i in range(max(pieces) + 1)]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, lexicon: str) -> Iterator[pa.RecordBatch]:
    encoder = transducing(path, lexicon)
    for batch in by_bytes(batches, "_text"):
        ids = pa.array(encoder.encode_all(batch.column("_text").to_pylist()), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("_key"), ids], ["_key", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    piece = piece_bytes(path).__getitem__
    for batch in by_bytes(batches, "ids"):
        texts = [b"".join(map(piece, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")
                 for ids in batch.column("ids").to_pylist()]
        named = {"_key": batch.column("_key")} | ({"ids": batch.column("ids")} if keep_ids else {})
        yield pa.RecordBatch.from_pydict(named | {"decoded": pa.array(texts, pa.string())})


def _keyed(df: DataFrame, key: str, column: str, name: str) -> tuple[DataFrame, str]:
    return df.select(df[key].alias("_key"), df[column].alias(name)), f"_key {dict(df.dtypes)[key]}"


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
           limit: int = LEXICON_WORDS) -> DataFrame:
    """``(key, ids)``: the ids of every whole text, as little-endian unsigned 32-bit integers.

    Null and empty texts give no ids. Repeated rows and null keys keep a row each; other columns are not read.
    """
    rows, kind = _keyed(docs, key, text, "_text")
    lexicon = ship_lexicon(docs, path, text, limit)
    out = rows.mapInArrow(lambda b: _encoded(b, path, lexicon), f"{kind}, ids binary")
    return out.withColumnRenamed("_key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, decoded)``: the text of ids as ``encode`` gives them, special tokens kept; null ids give ''."""
    rows, kind = _keyed(encoded, key, ids, "ids")
    return rows.mapInArrow(lambda b: _decoded(b, path, False), f"{kind}, decoded string").withColumnRenamed("_key", key)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
               limit: int = LEXICON_WORDS) -> DataFrame:
    """``(key, ids, decoded)``: ``encode`` and ``decode`` of its ids in one pass over the rows."""
    rows, kind = _keyed(docs, key, text, "_text")
    lexicon = ship_lexicon(docs, path, text, limit)
    out = rows.mapInArrow(lambda b: _decoded(_encoded(b, path, lexicon), path, True),
                          f"{kind}, ids binary, decoded string")
    return out.withColumnRenamed("_key", key)
