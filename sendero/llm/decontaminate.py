"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders, so an item and a copy with other values have one template. Windows
of ``WINDOW`` template tokens are joined by hash. A window counts only if every value of the item's slots stands for
one value in it. The windows of a document that lie on an item in one place are one match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sendero.llm.batches import by_bytes
from sendero.llm.shingles import STEP, mix, powers, window_hashes, word_hashes
from sendero.session import materialize

WINDOW = 10
#: Tokens of a window that have to be words; one of placeholders alone says nothing.
LITERAL = 5
#: Window hashes that tasks may hold; more are joined instead (8 bytes each).
HELD_WINDOWS = 1_000_000
MEMO_WORDS = 400_000
#: Rows of windows, each in one reading, that are worked on at a time.
READINGS = 1 << 16

# Units, one word each.
UNITS = frozenset(("mm cm m km in inch inches ft foot feet yd yard yards mi mile miles g kg mg t lb lbs pound pounds oz ounce "
         "ounces l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours "
         "day days week weeks month months year years usd eur dollar dollars cent cents euro euros percent").split())
WORD, NAME, NUMBER, UNIT, NOTHING = range(5)
EDGES = re.compile(r"^[^\w$€£%+-]+|[^\w$€£%]+$")
NUMERIC = re.compile(r"[+-]?[$€£]?[0-9][0-9.,:/]*%?")
MEASURED = re.compile(r"([+-]?[0-9][0-9.,]*)([a-z]+)")
PLACEHOLDERS = word_hashes([b"\x01name", b"\x01number", b"\x01unit"])[0]


class Templates(dict):
    """Numbers for stretches between blanks, and what each stretch may be, worked out once per distinct stretch."""

    def __init__(self):
        self.seen: list[tuple[str, int, bool, bool]] = []  # text, kind, capital, whether it ends a sentence
        self.columns = [np.empty(0, t) for t in (np.int8, bool, bool, np.uint64)]

    def __missing__(self, chunk: str) -> int:
        core = chunk
        if not chunk.isalpha():
            core = chunk[:-1] if chunk[:-1].isalpha() and chunk[-1] in ".,;:!?" else EDGES.sub("", chunk)
        low = core.lower()
        if low.isalpha():
            kind = UNIT if low in UNITS else WORD
        else:
            kind = NOTHING if not core else NUMBER if NUMERIC.fullmatch(low) or (
                (m := MEASURED.fullmatch(low)) and m[2] in UNITS) else WORD
        self[chunk] = number = len(self.seen)
        self.seen.append((low, kind, core[:1].isupper(), chunk[-1] in ".!?:;"))
        return number

    def read(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """``(numbers, kinds, hashes, either, plain, counts)`` of all texts' tokens in a row, and how many each text has.

        What has no letter or digit is no token. A capital makes a name; where it opens the text or follows the end of
        a sentence, the token is read as a word that may be a name too (``either``). A unit is one only right after a
        number. ``plain`` are the hashes without placeholders.
        """
        parts = [np.fromiter(map(self.__getitem__, t.split()), np.int64) for t in texts]
        sizes = np.array([len(p) for p in parts], np.int64)
        at = np.concatenate([*parts, np.empty(0, np.int64)])
        kinds, capital, ends, hashes = (column[at] for column in self._columns())
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        opens, after_number = np.roll(ends, 1), np.roll(kinds == NUMBER, 1)
        opens[first], after_number[first] = True, False
        kinds = np.where((kinds == UNIT) & ~after_number, WORD, kinds)
        either = (kinds == WORD) & capital & opens
        kinds = np.where((kinds == WORD) & capital & ~opens, NAME, kinds)
        plain = hashes.copy()
        for kind, value in zip((NAME, NUMBER, UNIT), PLACEHOLDERS):
            hashes[kinds == kind] = value
        kept = kinds != NOTHING
        counts = np.bincount(np.repeat(np.arange(len(texts)), sizes)[kept], minlength=len(texts))
        return at[kept], kinds[kept], hashes[kept], either[kept], plain[kept], counts

    def _columns(self) -> list[np.ndarray]:
        """Kind, capital, end and hash of all stretches seen so far."""
        texts, *new = zip(*self.seen[len(self.columns[0]):], strict=True) if len(self.seen) > len(self.columns[0]) else ((),) * 4
        own, counts = word_hashes([t.encode() for t in texts])
        hashes = np.zeros(len(counts), np.uint64)
        hashes[counts > 0] = own[(np.cumsum(counts) - counts)[counts > 0]]
        self.columns = [np.concatenate([old, np.array(more, old.dtype)]) for old, more in zip(self.columns, [*new, hashes])]
        return self.columns

    def bound(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()
            self.__init__()


def readings(tokens: np.ndarray, kinds: np.ndarray, either: np.ndarray, wanted: np.ndarray, size: int,
             literal: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(starts, as_names, hashes)``: the ``wanted`` windows, read in each way that leaves ``literal`` words.

    ``as_names`` has a bit for each place whose token, a word or a name, is read as a name. Comes in parts of about
    ``READINGS`` rows, however many ways there are.
    """
    words, open_ = (np.concatenate([[0], np.cumsum(x)]) for x in (kinds == WORD, either))
    starts = np.flatnonzero(wanted & (words[size:] - words[:len(wanted)] >= literal))
    ways = np.left_shift(1, open_[starts + size] - open_[starts])
    parts = np.flatnonzero(np.diff(np.cumsum(ways) // READINGS)) + 1
    places, factors = np.flatnonzero(either), powers(STEP, size)
    for at in np.split(starts, parts):
        sums, as_names = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
        for place, factor in enumerate(factors):
            sums += tokens[at + place] * factor
        left, first = words[at + size] - words[at] - literal, open_[at]
        last, nth = open_[at + size], 0
        while len(more := np.flatnonzero((last - first > nth) & (left > 0))):
            token = places[first[more] + nth]
            place = token - at[more]
            sums = np.concatenate([sums, sums[more] + (PLACEHOLDERS[0] - tokens[token]) * factors[place]])
            as_names = np.concatenate([as_names, as_names[more] | np.left_shift(1, place)])
            left = np.concatenate([left, left[more] - 1])
            at, first, last = (np.concatenate([x, x[more]]) for x in (at, first, last))
            nth += 1
        yield at, as_names, mix(sums)


def marks(held: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """A table in which a hash's highest bits are true for all of ``held``, and the shift that leaves them."""
    bits = max(16, len(held).bit_length() + 4)
    table = np.zeros(1 << bits, bool)
    table[held >> np.uint64(64 - bits)] = True
    return table, np.uint64(64 - bits)


def pairs_of(tokens: np.ndarray, either: np.ndarray) -> list[np.ndarray]:
    """Hashes of the pairs of neighbours, an array for each way to read the two."""
    named = np.where(either, PLACEHOLDERS[0], tokens)
    return [mix(a[:-1] + b[1:] * STEP) for a in (tokens, named) for b in (tokens, named)]


def believable(tokens: np.ndarray, kinds: np.ndarray, either: np.ndarray, size: int, literal: int, table: np.ndarray,
               shift: np.uint64) -> np.ndarray:
    """Which windows of ``size`` tokens can be ones whose pairs of neighbours are all in the table of ``marks``.

    Every pair has to be there in some way to read it, and ``literal`` words have to be left when those are taken out
    that, read as words, make no known pair with what stands beside them in the window.
    """
    def known(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return table[mix(a + b * STEP) >> shift]
    left, right = tokens[:-1], tokens[1:]
    after = known(left, right)  # a pair whose left token is a word, or has but one reading
    before = after.copy()  # the same of the right one
    name, new = PLACEHOLDERS[:1], np.flatnonzero(~after & either[1:])
    after[new] = known(left[new], name)
    new = np.flatnonzero(~before & either[:-1])
    before[new] = known(name, right[new])
    strange = ~(after | before | (either[:-1] & either[1:] & known(name, name)))
    word, no = kinds == WORD, [False]
    last = np.concatenate([word[:-1] & ~after, no])
    first = np.concatenate([no, word[1:] & ~before]) & ~last
    strange, word, last, first = (np.concatenate([[0], np.cumsum(x)]) for x in (strange, word, last, first))
    n = max(len(tokens) - size + 1, 0)
    spoken = (word[size:] - word[:n]) - (last[size - 1:][:n] - last[:n]) - (first[size:] - first[1:][:n])
    return (strange[size - 1:] == strange[:n]) & (spoken >= literal)


def exact_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A hash per start of ``size`` tokens as they are, other than any of a template or of another size."""
    return mix(window_hashes(tokens, size) + np.uint64(size))


def template_windows(rows: DataFrame, key: str, text: str, size: int, literal: int, held: np.ndarray | None = None,
                     exact: list[int] | None = None, pairs: np.ndarray | None = None) -> DataFrame:
    """``(hash, key, at, slots, exact)``: a text's template windows; only those in the sorted ``held``, if given.

    A word that may be a name gives a window either way. ``slots`` are the values of the window's placeholders, each
    with its kind before it; ``exact`` is 0.

    After them come windows of tokens as they are, without slots and with ``exact`` as their size: those of all sizes in
    ``exact`` or, if that is None, what has no template window: a window in which fewer than ``literal`` words are left
    when names are taken out, and the whole of a text with fewer than ``size`` tokens. If it is None, pairs of
    neighbours come too, with -1 as ``exact``; given as ``pairs``, they tell which windows cannot be in ``held``.
    """
    known = rows.sparkSession.sparkContext.broadcast(held) if held is not None else None
    paired = rows.sparkSession.sparkContext.broadcast(pairs) if pairs is not None else None

    def whole(n: int, owner: np.ndarray) -> np.ndarray:
        """Whether the window of ``n`` tokens from each start lies in one text."""
        return owner[n - 1:] == owner[:max(len(owner) - n + 1, 0)]

    def exactly(plain: np.ndarray, kinds: np.ndarray, either: np.ndarray, owner: np.ndarray, begins: np.ndarray,
                counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        words = np.concatenate([[0], np.cumsum((kinds == WORD) & ~either)])
        for n in range(1, size + 1) if exact is None else exact:
            wanted = whole(n, owner)
            if exact is None and n < size:
                starts = begins[counts == n]
            elif exact is None:
                starts = np.flatnonzero(wanted & (words[n:] - words[:len(wanted)] < literal))
            else:
                starts = np.flatnonzero(wanted)
            yield n, starts, np.zeros(len(starts), np.int64), exact_hashes(plain, n)[starts]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Templates()
        table, shift = marks(known.value) if known is not None else (None, None)
        pair_table, pair_shift = marks(paired.value) if paired is not None else (None, None)
        for batch in by_bytes(batches, "_text"):
            at, kinds, tokens, either, plain, counts = reader.read([t or "" for t in batch.column("_text").to_pylist()])
            begins = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(len(counts)), counts)
            wanted = whole(size, owner)
            if paired is not None and len(wanted):
                wanted &= believable(tokens, kinds, either, size, literal, pair_table, pair_shift)
            if exact is None and len(tokens):
                found = np.unique(np.concatenate(pairs_of(tokens, either)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64), pa.int64()), pa.nulls(len(found), pa.int64()), pa.nulls(len(found), pa.int64()),
                     pa.nulls(len(found), pa.list_(pa.string())), pa.array(np.full(len(found), -1), pa.int64())],
                    ["hash", "key", "at", "slots", "exact"])
            for n, starts, as_names, own in chain(
                    ((0, *found) for found in readings(tokens, kinds, either, wanted, size, literal)),
                    exactly(plain, kinds, either, owner, begins, counts)):
                if known is not None:
                    hits = np.flatnonzero(table[own >> shift])
                    near = np.minimum(np.searchsorted(known.value, own[hits]), max(len(known.value) - 1, 0))
                    hits = hits[known.value[near] == own[hits]] if len(known.value) else hits[:0]
                    starts, as_names, own = starts[hits], as_names[hits], own[hits]
                if not len(starts):
                    continue
                slots = [[] if n else [f"{NAME if names >> m & 1 else k}{reader.seen[t][0]}" for m, (t, k) in enumerate(
                          zip(at[i:i + size].tolist(), kinds[i:i + size].tolist())) if k != WORD or names >> m & 1]
                         for i, names in zip(starts.tolist(), as_names.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64), pa.int64()), batch.column("_key").take(pa.array(owner[starts])),
                     pa.array(starts - begins[owner[starts]], pa.int64()), pa.array(slots, pa.list_(pa.string())),
                     pa.array(np.full(len(starts), n), pa.int64())], ["hash", "key", "at", "slots", "exact"])
            reader.bound()
    keyed = rows.select(rows[key].cast("bigint").alias("_key"), rows[text].alias("_text"))
    return keyed.mapInArrow(emit, "hash bigint, key bigint, at bigint, slots array<string>, exact bigint")


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", size: int = WINDOW, literal: int = LITERAL) -> DataFrame:
    """``(doc_id, item_id, first_token, n_windows, n_changed)`` of every match of a document with a benchmark item.

    A match is an item laid on a document in one place so that at least one window of ``size`` template tokens agrees,
    ``literal`` of them words, and its slots are consistent: each of the item's values became one value in the window,
    as in a verbatim one. Windows that are not do not count, and speak against no other. ``n_changed`` counts changes of
    values. An item of fewer tokens is one window, and has to be there as it is, as has a window with fewer words.
    Null and empty items and texts match nothing; rows with null keys take no part; repeated rows count once. Other columns are not read. Without items or documents there are no rows.

    The items' window hashes go to the tasks if there are at most ``HELD_WINDOWS``; else all windows are joined.
    """
    every = materialize(template_windows(benchmark.where(benchmark[item].isNotNull()), item, item_text, size, literal)
                        .select("hash", F.col("key").alias("item_id"), F.col("at").alias("item_at"),
                                F.col("slots").alias("item_slots"), "exact").distinct())
    items, neighbours = every.where("exact >= 0"), every.where("exact < 0").select("hash").distinct()
    exact = sorted(r["exact"] for r in items.where("exact > 0").select("exact").distinct().collect())
    hashes = items.select("hash").distinct()
    held, pairs = (np.sort(np.array([r["hash"] for r in few.collect()], np.int64).view(np.uint64))
                   if few.count() <= HELD_WINDOWS else None for few in (hashes, neighbours))
    found = template_windows(docs.where(docs[key].isNotNull()), key, text, size, literal, held, exact, pairs)
    laid = (found.drop("exact").join(items, "hash").withColumn("first_token", F.col("at") - F.col("item_at"))
            .select("item_id", F.col("key").alias("doc_id"), "first_token", "at",
                    F.array_distinct(F.arrays_zip(F.col("item_slots").alias("of"), F.col("slots").alias("became"))).alias("pairs"))
            .where(F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["of"])))))
    together = (laid.groupBy("doc_id", "item_id", "first_token")
                .agg(F.countDistinct("at").alias("n_windows"),
                     F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")))
    return together.select(
        "doc_id", "item_id", "first_token", "n_windows",
        F.size(F.filter("pairs", lambda p: p["of"] != p["became"])).cast("bigint").alias("n_changed"))
