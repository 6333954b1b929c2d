"""JSON files that hold one array of records each, read in ranges.

A range of a file does not tell whether it starts inside a text or how deep in the array. But what it changes is known
for both cases: a first pass finds, per range, whether it turns inside to outside and how far it goes up or down if it
starts outside a text and if it starts inside one. Running sums over a file's ranges then give the state at the start of
each, and a second pass cuts the ranges into records. A record that crosses ranges is put together from its parts. Spark's
text reader deals out the ranges, with the closing brace as its line end, so no long line is needed and none is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from sendero.session import table_path

#: A text, whole or cut off at the end, a character that has to do with depth, or an escaped one: escapes stand in texts
#: only, but a range that is taken to start outside may start inside, and then has to find the same quotes.
TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+(?:"|\Z)|[{}\[\],]|\\.', re.DOTALL)
REST_OF_TEXT = re.compile(r'(?:[^"\\]++|\\.)*+(?:"|\Z)', re.DOTALL)
STEP = {"{": 1, "[": 1, "}": -1, "]": -1}
BATCH_CHARS = 1 << 22

PIECES = pa.schema([("file", pa.string()), ("start", pa.int64()), ("part", pa.int32()), ("text", pa.string())])


def tokens(piece: str, inside: bool) -> Iterator[re.Match]:
    """Tokens of a piece; ``inside`` if it starts within a text, the rest of which is the first token then."""
    at = 0
    if inside:
        first = REST_OF_TEXT.match(piece)
        yield first
        at = first.end()
    yield from TOKEN.finditer(piece, at)


def ends_inside(piece: str, token: re.Match | None, inside: bool) -> bool:
    """Whether a piece with this last token ends within a text."""
    if token is None or token.end() < len(piece):
        return False
    text = token.group()
    opened = inside and token.start() == 0
    if not opened and not text.startswith('"'):
        return False
    body = text if opened else text[1:]
    return not (body.endswith('"') and (len(body) - 1 - len(body[:-1].rstrip("\\"))) % 2 == 0)


def effect(piece: str, inside: bool) -> tuple[bool, int]:
    """Whether the piece ends within a text, and how much deeper than it started."""
    depth, last = 0, None
    for last in tokens(piece, inside):
        depth += STEP.get(last.group(), 0) if not (inside and last.start() == 0) else 0
    return ends_inside(piece, last, inside), depth


def _by_range(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``(file, start, piece, inside, depth)`` in the order of the file, the closing brace put back."""
    for batch in batches:
        columns = batch.to_pydict()
        state = zip(columns["inside"], columns["depth"]) if "inside" in columns else iter(lambda: (None, None), 0)
        for file, start, piece, (inside, depth) in zip(columns["file"], columns["start"], columns["piece"], state):
            yield file, start, piece + "}", inside, depth


def _effects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each range does to the state it starts in, one row per range."""
    found: dict[tuple, list] = {}
    for file, start, piece, _, _ in _by_range(batches):
        outcomes = found.setdefault((file, start), [[False, 0], [True, 0]])
        for outcome in outcomes:
            outcome[0], deeper = effect(piece, outcome[0])
            outcome[1] += deeper
    rows = [(file, start, int(out[0]), out[1], within[1]) for (file, start), (out, within) in found.items()]
    names = ["file", "start", "turns", "from_outside", "from_inside"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        map(list, zip(*rows)) if rows else [[]] * 5, [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()])], names)


class Cutter:
    """Cuts the pieces of one range into records: whole ones as part 0, what others share with neighbours as 1 and 2.

    Part 1 goes on with a record of an earlier range; part 2 begins one that may go on in a later range.
    """

    def __init__(self, file: str, inside: bool, depth: int):
        self.file, self.inside, self.depth = file, inside, depth
        self.part = 1 if depth else 2
        self.open: list[str] = []

    def feed(self, piece: str) -> Iterator[tuple[int, str]]:
        began, last, resumed = 0, None, self.inside
        for last in tokens(piece, self.inside):
            token = last.group()
            if resumed:
                resumed = False
                continue
            if self.depth == 0 and token == "[":
                self._blank(piece[began:last.start()])
                began, self.depth = last.end(), 1
            elif self.depth == 0 and token == "}" and last.end() == len(piece):
                self._blank(piece[began:last.start()])
                began = last.end()  # put back, but not there: the file ends with its array
            elif self.depth == 0:
                raise ValueError(f"{self.file} does not hold one JSON array")
            elif self.depth == 1 and token in ",]":
                yield self._close(piece[began:last.start()])
                began, self.depth = last.end(), self.depth - (token == "]")
            else:
                self.depth += STEP.get(token, 0)
        self.inside = ends_inside(piece, last, self.inside)
        if self.depth == 0:
            self._blank(piece[began:])
        else:
            self.open.append(piece[began:])

    def _close(self, text: str) -> tuple[int, str]:
        record = "".join([*self.open, text])
        part = 1 if self.part == 1 else 0
        self.open, self.part = [], 2
        return part, record

    def _blank(self, text: str) -> None:
        if text.strip("\ufeff \t\r\n"):
            raise ValueError(f"{self.file} does not hold one JSON array")

    def rest(self) -> Iterator[tuple[int, str]]:
        if self.depth:
            yield self.part, "".join(self.open)


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held, at, cutter = 0, None, None

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*rows)), PIECES)], schema=PIECES)
        rows.clear()
        return made
    for file, start, piece, inside, depth in _by_range(batches):
        if (file, start) != at:
            if cutter:
                rows += [(*at, part, text) for part, text in cutter.rest()]
            at, cutter = (file, start), Cutter(file, inside, depth)
        for part, text in cutter.feed(piece):
            rows.append((*at, part, text))
            held += len(text)
        if held > BATCH_CHARS:
            yield batch()
            held = 0
    if cutter:
        rows += [(*at, part, text) for part, text in cutter.rest()]
    if rows:
        yield batch()


def range_states(effects: DataFrame) -> DataFrame:
    """``(file, start, inside, depth)`` at the start of each range, from running sums over the ranges of its file."""
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turned = effects.withColumn("inside", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2 == 1)
    deeper = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    return turned.select("file", "start", "inside", F.coalesce(F.sum(deeper).over(earlier), F.lit(0)).cast("int").alias("depth"))


def json_array_texts(spark: SparkSession, path: str) -> DataFrame:
    """``text``: the records of the arrays under a path or glob, each as its JSON text.

    The files are read twice; the records are written once to the shared folder. What goes to all tasks is a row per range,
    less than a millionth of the input with Spark's range size of 128 MB. A file that holds no array is an error.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))
    effects = pieces.mapInArrow(_effects, "file string, start bigint, turns int, from_outside bigint, from_inside bigint")
    known = table_path(spark, "json-ranges")
    effects.write.parquet(known)
    states = range_states(spark.read.parquet(known))
    cut = pieces.join(F.broadcast(states), ["file", "start"]).select("file", "start", "piece", "inside", "depth").mapInArrow(
        _cut, "file string, start bigint, part int, text string")
    out = table_path(spark, "json-records")
    cut.write.parquet(out)
    found = spark.read.parquet(out)
    # A part 2 begins a record, a part 1 goes on with it: as many begun so far, as many records.
    order = Window.partitionBy("file").orderBy("start", "part")
    shared = found.where("part > 0").withColumn("record", F.sum((F.col("part") == 2).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "part", "text")))
    joined = shared.groupBy("file", "record").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    return found.where("part = 0").select("text").unionByName(joined.select("text")).where(F.trim(F.translate("text", "\t\r\n", "   ")) != "")


def read_json_arrays(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The records of JSON arrays as a table, in no order; one that does not fit the schema is an error.

    A file is read by as many tasks as it has ranges (``spark.sql.files.maxPartitionBytes``), and the rows do not depend on them.
    """
    record = F.from_json("text", schema if isinstance(schema, str) else schema.simpleString(), {"mode": "FAILFAST"})
    return json_array_texts(spark, path).select(record.alias("r")).select("r.*")


def write_json_arrays(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Every task writes its rows as one file with one array; a task without rows writes an empty array."""
    def array(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = "["
        for batch in batches:
            if batch.num_rows:
                texts = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([sign + texts[0], *("," + t for t in texts[1:])], pa.string())], ["value"])
                sign = ","
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if sign == "[" else "]"], pa.string())], ["value"])
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(array, "value string").write.mode(mode).option(
        "lineSep", "\n").text(path)
    return path
