"""Near-duplicate documents by b-bit MinHash.

Equal shingle sets are one *representative*. A representative has ``MINIMA`` minima; bands of ``ROWS`` whole ones
give the buckets, and the lowest ``B`` bits of all minima, packed, give a similarity estimate by counting bits,
corrected for chance collisions. Estimated pairs are confirmed on the full sets.

No bucket is expanded into all pairs. First every document meets the smallest member of all its buckets, then, if it is
still apart, the smallest member of each bucket. What is then in several components of one bucket meets there: members
outside the bucket's largest component against all others, in large buckets by blocks and best estimates first, and only
likely pairs that could still join two components are confirmed. In blocks, 16-bit prints of all shingles bound what two
sets can share; pairs whose bound is below the threshold need no texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sendero.llm.batches import by_bytes
from sendero.llm.scratch import drop_finished_shuffles
from sendero.llm.shingles import mix, ranges, shingle_sets
from sendero.session import compacted, materialize, table_path

BANDS, ROWS = 32, 4
#: Minima of a set; the first ``BANDS * ROWS`` of them make the bands, all of them the estimate.
MINIMA = 256
B = 2
SIGNATURE_LONGS = MINIMA * B // 64
#: 3.4 standard errors of the estimate at a similarity of 0.8, 3.8 at 0.85; pairs this far below the threshold are left out.
MARGIN = 0.1
BLOCK_ROWS = 1024
#: Partners of a document in a block that the first round confirms.
FIRST_ROUND = 8
#: Most shingles of which prints are kept; pairs of a larger set go by the estimate alone.
MAX_PRINTS = 8192
EVEN_BITS = 0x5555555555555555
#: Bucket members with signatures, and pairs with texts, that are worth a task.
MEMBERS_PER_PART, PAIRS_PER_PART = 50_000, 2_000

_random = np.random.default_rng(5)
FACTORS = _random.integers(0, 2**32, MINIMA, np.uint32) | np.uint32(1)
SHIFTED = _random.integers(0, 2**32, MINIMA, np.uint32)
SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("content", pa.binary()),
                    ("bands", pa.list_(pa.int64())), ("packed", pa.list_(pa.int64()))])


def as_bytes(text: str | None) -> bytes:
    """A text with A-Z lower-cased."""
    return (text or "").encode().lower()


def minima(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of minima per non-empty set."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), len(FACTORS)), np.uint32)
    for i, (factor, shift) in enumerate(zip(FACTORS, SHIFTED)):
        out[:, i] = np.minimum.reduceat(high * factor + shift, starts) if len(starts) else 0
    return out


def band_keys(minima_: np.ndarray) -> np.ndarray:
    parts = minima_[:, :BANDS * ROWS].reshape(len(minima_), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        keys = mix(keys + parts[:, :, i])
    return keys.view(np.int64)


def pack_bits(minima_: np.ndarray) -> np.ndarray:
    """The lowest ``B`` bits of each minimum, packed into ``SIGNATURE_LONGS`` integers."""
    low = (minima_ & np.uint32(2**B - 1)).astype(np.uint64).reshape(len(minima_), SIGNATURE_LONGS, 64 // B)
    places = np.arange(0, 64, B, dtype=np.uint64)
    return np.bitwise_or.reduce(low << places, axis=2).view(np.int64)


def sign(docs: DataFrame, size: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, content, bands, packed)``; the last three are null for an empty set."""
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "_text"):
            texts = [as_bytes(t) for t in batch.column("_text").to_pylist()]
            hashes, counts = shingle_sets(texts, size)
            filled, starts = counts > 0, (np.cumsum(counts) - counts)[counts > 0]
            least = minima(hashes, counts)
            sums = [np.add.reduceat(mix(hashes + np.uint64(s)), starts) if len(starts) else hashes for s in (1, 2)]
            content = iter(np.stack(sums, axis=1).tobytes()[i:i + 16] for i in range(0, 16 * len(starts), 16))
            bands, packed = iter(band_keys(least).tolist()), iter(pack_bits(least).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 *(pa.array([next(v) if f else None for f in filled], t.type)
                   for v, t in zip((content, bands, packed), list(SIGNED)[2:]))], schema=SIGNED)
    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("_text"))
    return rows.mapInArrow(signed, "doc_id bigint, n_shingles bigint, content binary, bands array<bigint>, "
                                   "packed array<bigint>")


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures: the share of equal values, less what chance makes equal."""
    def differing(i: int) -> Column:
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(EVEN_BITS)))
    unequal = sum((differing(i) for i in range(1, SIGNATURE_LONGS)), differing(0)) / MINIMA
    return (1 - unequal - 2.0**-B) / (1 - 2.0**-B)


def prints(texts: DataFrame, size: int) -> DataFrame:
    """``(doc_id, set_size, prints)`` of ``texts (doc_id, text)``: the distinct low 16 bits of a set's shingles, null for large sets."""
    def low_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            hashes, counts = shingle_sets([as_bytes(t) for t in batch.column("text").to_pylist()], size)
            low, ends = hashes.astype(np.uint16), np.cumsum(counts)
            found = [np.unique(low[e - n:e]).tobytes() if n <= MAX_PRINTS else None for e, n in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.binary())],
                                             ["doc_id", "set_size", "prints"])
    return texts.mapInArrow(low_bits, "doc_id bigint, set_size bigint, prints binary")


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int, documents: int) -> DataFrame:
    """The ``pairs (a, b)`` whose full sets have ``100 * shared >= percent * all``. ``texts``: ``(doc_id, text)`` of so many ``documents``."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in by_bytes(batches, "text_a"):
            keep = []
            ours, counts = shingle_sets([as_bytes(t) for t in batch.column("text_a").to_pylist()], size)
            ends, other = np.cumsum(counts), batch.column("text_b").to_pylist()
            for i, b in enumerate(batch.column("b").to_pylist()):
                if (b, other[i]) != last:
                    last, held = (b, other[i]), shingle_sets([as_bytes(other[i])], size)[0]
                own = ours[ends[i] - counts[i]:ends[i]]
                shared = len(np.intersect1d(own, held, assume_unique=True))
                keep.append(100 * shared >= percent * (len(own) + len(held) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    first = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = first.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return (compacted(both.select("a", "b", "text_a", "text_b"), documents, PAIRS_PER_PART)
            .mapInArrow(exact, "a bigint, b bigint"))


def components(links: DataFrame) -> DataFrame:
    """``(doc_id, component)``: the smallest id each linked document reaches. ``links (a, b)`` in either direction.

    Every round takes the smallest label around, then the label of that label, so long chains shorten by halves. What the
    driver and the disk hold of a round is let go after it. ``links`` are read twice, so they should be materialized; tables are
    as many files as the links take.
    """
    spark = links.sparkSession
    number = links.count()
    if not number:
        return links.select(F.col("a").alias("doc_id"), F.col("b").alias("component"))
    ways = materialize(compacted(links.select("a", "b").union(links.select("b", "a")).distinct(), 2 * number))
    labels = materialize(compacted(ways.groupBy(F.col("a").alias("doc_id"))
                                   .agg(F.least(F.col("a"), F.min("b")).alias("component")), 2 * number))
    while True:
        around = (ways.join(labels.withColumnRenamed("doc_id", "b"), "b")
                  .groupBy(F.col("a").alias("doc_id")).agg(F.min("component").alias("near")))
        lower = labels.join(around, "doc_id").select("doc_id", "component", F.least("component", "near").alias("low"))
        up = labels.select(F.col("doc_id").alias("low"), F.col("component").alias("lowest"))
        moved = materialize(compacted(lower.join(up, "low").select("doc_id", F.least("low", "lowest").alias("to"), "component"),
                                      2 * number))
        labels = moved.select("doc_id", F.col("to").alias("component"))
        done = moved.where(F.col("to") != moved["component"]).isEmpty()
        del around, lower, up, moved
        drop_finished_shuffles(spark)
        if done:
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels (doc_id, component)`` of all documents after more ``links (a, b)`` between them.

    Only components that the new links touch are gone through, each as one vertex, however many documents it has.
    """
    ends = links
    for end in ("a", "b"):
        ends = ends.join(labels.select(F.col("doc_id").alias(end), F.col("component").alias(f"of_{end}")), end)
    between = materialize(compacted(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).where("a != b").distinct(),
                                    links.count()))
    into = components(between).select(F.col("doc_id").alias("component"), F.col("component").alias("to"))
    return materialize(compacted(labels.join(into, "component", "left").select(
        "doc_id", F.coalesce("to", "component").alias("component")), labels.count()))


def _first_shared(x: Column, y: Column) -> Column:
    """The first band in which two documents meet: there, and in no other bucket, their pair is looked at."""
    return F.array_position(F.zip_with(x, y, lambda a, b: a == b), F.lit(True)) - 1


def _open_buckets(members: DataFrame) -> DataFrame:
    """``members`` of buckets with several components, their bucket's size ``n`` and largest component ``main``.

    ``outside`` says who is not in ``main``, and ``apart`` how many these are. Where ``members`` have them from an earlier
    round, they stay as they were.
    """
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max_by("component", F.struct("n", "component")).alias("main"),
                                       F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("parts")).where("parts > 1")
    if "outside" in members.columns:
        return members.join(main.drop("parts", "most"), "bucket")
    found = members.join(main.select("bucket", "main", "n", (F.col("n") - F.col("most")).alias("apart")), "bucket")
    return found.withColumn("outside", F.col("component") != F.col("main"))


def _pairs_with_leaders(open_members: DataFrame, low: float) -> DataFrame:
    """Likely pairs ``(a, b)`` of a member and its bucket's smallest member, in different components."""
    leaders = open_members.where("doc_id = b").select("bucket", F.col("component").alias("theirs"), F.col("packed").alias("y"))
    return (open_members.join(leaders, "bucket").where((F.col("component") != F.col("theirs")) & (estimate("packed", "y") >= low))
            .select(F.col("doc_id").alias("a"), "b").distinct())


def _pairs_in_small(open_members: DataFrame, low: float) -> DataFrame:
    """Likely pairs ``(a, b)`` of different components in buckets of at most ``BLOCK_ROWS``, by a join per bucket."""
    small = open_members.where(F.col("n") <= BLOCK_ROWS)
    names = ["doc_id", "component", "bands", "packed"]
    x = small.where(F.col("component") != F.col("main")).select(
        "bucket", "band", F.col("main").alias("main"), *[F.col(c).alias(f"x_{c}") for c in names])
    y = small.select(F.col("bucket").alias("y_bucket"), *[F.col(c).alias(f"y_{c}") for c in names])
    # Two outsiders see each other twice; the smaller id speaks.
    once = (F.col("y_component") == F.col("main")) | (F.col("x_doc_id") < F.col("y_doc_id"))
    met = _first_shared(F.col("x_bands"), F.col("y_bands")) == F.col("band")
    likely = ((F.col("bucket") == F.col("y_bucket")) & (F.col("x_component") != F.col("y_component")) & once
              & (estimate("x_packed", "y_packed") >= low) & met)
    return x.join(y, likely).select(F.greatest("x_doc_id", "y_doc_id").alias("a"),
                                    F.least("x_doc_id", "y_doc_id").alias("b"))


def _may_link(own: int, others: np.ndarray, shared: np.ndarray, repeats: int, their_repeats: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``own`` and ``others`` shingles can be linked that share so many prints.

    Shared shingles have shared prints, and a set has at most ``repeats`` more shingles than prints.
    """
    most = shared + np.minimum(repeats, their_repeats)
    return 100 * most >= percent * (own + others - most)


def _pairs_in_large(open_members: DataFrame, low: float, ranks: tuple[int, int | None], texts: DataFrame, size: int,
                    percent: int) -> DataFrame:
    """The same in larger buckets, by blocks of about ``BLOCK_ROWS``: outsiders against all.

    A member is sent to as many blocks as outsiders fill, an outsider to all blocks of its bucket. Of each outsider's likely
    partners in a block that prints do not rule out, sorted by estimate, those with a place in ``ranks`` come out. Who is
    an outsider was settled before the first round, so what that round put off is said by the same member in the second,
    whatever has been joined meanwhile.
    """
    large = open_members.where(F.col("n") > BLOCK_ROWS)
    number = large.count()
    shown = prints(compacted(texts.join(large.select("doc_id").distinct(), "doc_id"), number, PAIRS_PER_PART), size)

    def blocks(n: str) -> Column:
        return F.ceil(F.col(n) / BLOCK_ROWS)

    def block(n: str) -> Column:
        return F.pmod(F.xxhash64("doc_id"), blocks(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), blocks(n) - 1))
    columns = ["band", "doc_id", "component", "bands", "packed", "set_size", "prints"]
    rows = materialize(compacted(large.join(shown, "doc_id"), number, MEMBERS_PER_PART))
    outside = rows.where("outside").select("bucket", block("apart").alias("i"), every("n").alias("j"), *columns)
    inside = rows.select(F.col("bucket").alias("bucket"), every("apart").alias("i"), block("n").alias("j"),
                         *[F.col(c).alias(c) for c in columns])  # columns of their own, not shared with the other side
    most = int((1 - low) * (1 - 2.0**-B) * MINIMA)

    def matrix(t: pa.Table, column: str) -> np.ndarray:
        return t.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)

    def low_bits(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The prints of all rows, where each row's begin, how many there are, and whether it has any."""
        held = t.column("prints").to_pylist()
        lengths = np.array([len(p or b"") // 2 for p in held], np.int64)
        flat = np.frombuffer(b"".join(p or b"" for p in held), np.uint16)
        return flat, np.cumsum(lengths) - lengths, lengths, lengths > 0

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, parts = ([t.column(c).to_numpy() for t in (left, right)] for c in ("doc_id", "component"))
        bands, bits = ([matrix(t, c) for t in (left, right)] for c in ("bands", "packed"))
        band, found = left.column("band")[0].as_py(), ([], [])
        sizes = [t.column("set_size").to_numpy() for t in (left, right)]
        (mine, mine_at, mine_n, mine_known), (flat, at, n, known) = low_bits(left), low_bits(right)
        for row in range(len(ids[0])):
            x = (bits[1] ^ bits[0][row]).view(np.uint64)
            unequal = np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(EVEN_BITS)).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero((unequal <= most) & (ids[1] != ids[0][row]))
            near = near[np.lexsort((ids[1][near], unequal[near]))]
            near = near[(bands[1][near] == bands[0][row]).argmax(axis=1) == band]
            if mine_known[row] and len(near):
                own = np.zeros(1 << 16, bool)
                own[mine[mine_at[row]:mine_at[row] + mine_n[row]]] = True
                met, ends = np.concatenate([[0], np.cumsum(own[flat[ranges(at[near], n[near])]])]), np.cumsum(n[near])
                near = near[~known[near] | _may_link(sizes[0][row], sizes[1][near], met[ends] - met[ends - n[near]],
                                                     sizes[0][row] - mine_n[row], sizes[1][near] - n[near], percent)]
            near = near[ranks[0]:ranks[1]]
            near = near[parts[1][near] != parts[0][row]]
            found[0].append(np.maximum(ids[1][near], ids[0][row]))
            found[1].append(np.minimum(ids[1][near], ids[0][row]))
        return pa.Table.from_arrays([pa.array(np.concatenate(f), pa.int64()) for f in found], schema=schema)
    block = ["bucket", "i", "j"]
    return outside.groupBy(*block).cogroup(inside.groupBy(*block)).applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a set holds the distinct ``size``-word
    shingles, or the whole sequence of a shorter text. Two sets are linked if ``100 * shared >= percent * all``;
    ``component_id`` is the smallest key reachable and ``kept`` says that it is the row's own. Null, empty and blank
    texts have no shingles and stand alone. Repeated rows keep a row each; rows of one key
    with different texts are one document, linked by any of its texts. Null keys are linked with nothing and not kept. Other columns are not read.
    """
    low = percent / 100 - MARGIN
    spark = docs.sparkSession
    path = table_path(spark, "near")
    sign(docs, size, key, text).write.parquet(f"{path}/signed")
    signed = spark.read.parquet(f"{path}/signed")
    filled = signed.where("content is not null and doc_id is not null")
    documents = signed.count()
    classes = materialize(compacted(filled.groupBy("content").agg(F.min("doc_id").alias("rep")), documents))
    reps = (filled.join(classes, "content").where("doc_id = rep").dropDuplicates(["doc_id", "content"])
            .select("doc_id", "bands", "packed"))
    members = reps.select("doc_id", F.posexplode("bands").alias("band", "bucket"))
    buckets = members.groupBy("bucket").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).where("n > 1")
    shared = materialize(compacted(members.join(buckets.select("bucket", "b"), "bucket"), BANDS * documents, MEMBERS_PER_PART))
    family = materialize(compacted(shared.select("doc_id").distinct(), documents))
    signatures = materialize(compacted(reps.join(family, "doc_id"), documents, MEMBERS_PER_PART))
    whole = docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    whole.join(family, "doc_id").dropDuplicates(["doc_id", "text"]).write.parquet(f"{path}/texts")
    texts = spark.read.parquet(f"{path}/texts")

    drop_finished_shuffles(spark)

    def placed(labels: DataFrame, members: DataFrame = shared) -> DataFrame:
        """Those of ``members`` whose buckets still hold several components, with all that pairs are judged by."""
        found = materialize(compacted(_open_buckets(members.join(labels, "doc_id")).join(signatures, "doc_id"),
                                      members.count(), MEMBERS_PER_PART))
        drop_finished_shuffles(spark)
        return found

    def confirmed(pairs: DataFrame) -> DataFrame:
        found = materialize(confirm(pairs, texts, size, percent, documents))
        drop_finished_shuffles(spark)
        return found

    first = shared.groupBy(F.col("doc_id").alias("a")).agg(F.min("b").alias("b")).where("a != b")
    labels = merged(family.withColumn("component", F.col("doc_id")), confirmed(first))
    labels = merged(labels, confirmed(_pairs_with_leaders(placed(labels), low)))
    waiting = placed(labels)
    put_off = materialize(compacted(waiting.where(F.col("n") > BLOCK_ROWS).select(*shared.columns, "outside", "apart"),
                                    BANDS * documents, MEMBERS_PER_PART))
    pairs = _pairs_in_large(waiting, low, (0, FIRST_ROUND), texts, size, percent).union(_pairs_in_small(waiting, low))
    labels = merged(labels, confirmed(pairs.distinct()))
    del waiting, pairs
    pairs = _pairs_in_large(placed(labels, put_off), low, (FIRST_ROUND, None), texts, size, percent)
    labels = merged(labels, confirmed(pairs.distinct()))
    del pairs
    reached = classes.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "content", F.coalesce("component", "rep").alias("component"))
    out = signed.join(reached, "content", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
