"""Secrets by fixed shapes, told apart by who owns them in the whole corpus.

Shapes find assignments, access keys and hexadecimal strings; beside them any run of credential characters that mixes
letters and digits is a candidate. Every candidate's value is hashed, and the hash is counted by distinct repositories and
distinct owners. A value in many of both is a widely copied example; one that looks live and is not copied belongs to
its owner. Two kinds of candidates that no shape reports are then added as ``found``: values that a shape reported
elsewhere, and mixed-case ones that no one else holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sendero.llm.batches import by_bytes
from sendero.operators.skew import hot_keys, lookup_join
from sendero.session import materialize, table_path

# Kinds in their order, shapes, least lengths, and words of placeholders. Either case of a letter is
# written out, for only ASCII letters are meant.
KINDS = ["assign", "access", "hex"]
FOUND = len(KINDS)
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
EITHER_CASE = "|".join(re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", word) for word in KEYWORDS)
VALUE = "[A-Za-z0-9+/_.=-]"
SHAPES = {
    "assign": f"({EITHER_CASE})[\"']?\\x20*[:=]\\x20*[\"']?({VALUE}+)",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
LEAST = {"assign": 12, "access": 18, "hex": 16}
PLACEHOLDERS = ["example", "sample", "dummy", "changeme", "placeholder", "redacted", "xxxx"]

#: A run of credential characters of a length that may hide one; shorter ones have too many owners by chance.
CANDIDATE = 12
#: From this length on a mixed-case candidate is added though no shape reported its value anywhere.
MIXED = 16
DISTINCT = 8
#: A value in so many repositories, of so many owners, is a copied example.
COPIED_REPOSITORIES, COPIED_OWNERS = 5, 3
SPANS = "array<struct<start:int,kind:int,end:int,hash:binary,live:boolean,mixed:boolean>>"

_assign, _access = re.compile(SHAPES["assign"]), re.compile(SHAPES["access"])
_hex = re.compile("[0-9a-f]{%d,}" % LEAST["hex"])  # runs that are long enough: the same matches
_candidate = re.compile("%s{%d,}" % (VALUE, CANDIDATE))
_digit, _lower, _upper = re.compile("[0-9]"), re.compile("[a-z]"), re.compile("[A-Z]")


def looks_live(value: str) -> bool:
    """Letters and digits, enough distinct characters, no word of a placeholder."""
    lowered = value.lower()
    return bool(_digit.search(value) and (_lower.search(lowered)) and len(set(value)) >= DISTINCT
                and not any(word in lowered for word in PLACEHOLDERS))


def spans_in(text: str) -> list[tuple]:
    """``(start, kind, end, hash, live, mixed)`` of base spans and of candidates that overlap none, in order."""
    base = [(m.start(), 0, m.end(), m[2]) for m in _assign.finditer(text) if len(m[2]) >= LEAST["assign"]]
    base += [(m.start(), 1, m.end(), m[0]) for m in _access.finditer(text) if len(m[0]) >= LEAST["access"]]
    base += [(m.start(), 2, m.end(), m[0]) for m in _hex.finditer(text)]
    base.sort()
    spans = []
    at, reached = 0, 0  # base spans before ``at`` start no later than the candidate; they reach up to ``reached``
    for m in _candidate.finditer(text):
        value = m[0].strip(".")
        if not _digit.search(value) or len(value) < CANDIDATE:
            continue
        start = m.start() + m[0].index(value)
        end = start + len(value)
        while at < len(base) and base[at][0] < end:
            reached = max(reached, base[at][2])
            at += 1
        if reached <= start and looks_live(value):
            mixed = len(value) >= MIXED and bool(_lower.search(value)) and bool(_upper.search(value))
            spans.append((start, FOUND, end, value_hash(value), True, mixed))
    for start, kind, end, value in base:
        spans.append((start, kind, end, value_hash(value.strip(".")), looks_live(value), False))
    return sorted(spans, key=lambda s: s[:3])


def value_hash(value: str) -> bytes:
    return blake2b(value.encode(), digest_size=16).digest()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()),
                               ("live", pa.bool_()), ("mixed", pa.bool_())]))
    names = ["start", "kind", "end", "hash", "live", "mixed"]
    for batch in by_bytes(batches, "text"):
        spans = [[dict(zip(names, s)) for s in spans_in(text or "")] for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "owner", "repository")), pa.array(spans, kind)],
                                         ["key", "owner", "repository", "spans"])


def scan(docs: DataFrame, key: str, text: str, owner: str, repository: str) -> DataFrame:
    """``(uid, key, owner, repository, spans)``, written to the shared folder; texts are read once."""
    rows = docs.select(docs[key].cast("bigint").alias("key"), docs[owner].cast("string").alias("owner"),
                       docs[repository].cast("string").alias("repository"), docs[text].cast("string").alias("text"))
    path = table_path(docs.sparkSession, "secrets")
    (rows.mapInArrow(_scan, f"key bigint, owner string, repository string, spans {SPANS}")
     .withColumn("uid", F.monotonically_increasing_id()).write.parquet(path))
    return docs.sparkSession.read.parquet(path)


def ownership(mentions: DataFrame) -> DataFrame:
    """``(hash, mentions, owners, repositories, reported)`` of each value; ``reported`` if a shape found it anywhere.

    ``mentions (hash, owner, repository, kind)``. A row is counted before it moves, by value, owner and repository first,
    so no value's holders ever meet in one task. A null owner is an owner.
    """
    held = mentions.groupBy("hash", "owner", "repository").agg(
        F.count("*").alias("n"), F.max(F.col("kind") < FOUND).alias("reported"))
    owned = held.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"), F.max("reported").alias("reported"))
    return owned.groupBy("hash").agg(F.sum("n").alias("mentions"), F.count("*").alias("owners"),
                                     F.sum("repositories").alias("repositories"), F.max("reported").alias("reported"))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id",
                 copied: tuple[int, int] = (COPIED_REPOSITORIES, COPIED_OWNERS), min_hot_rows: int = 1_000_000) -> DataFrame:
    """``(key, spans)`` of every row: spans ``(start, kind, end, owners, repositories, state)`` in code points, end exclusive, sorted.

    Kinds 0 to 2 are base spans of ``KINDS``, 3 is ``found``. ``state`` is "copied" for a value in at least ``copied[0]``
    repositories of at least ``copied[1]`` owners, else "live" where it looks like a credential, else "plain". A null
    repository is one of its own for each row. Null and empty texts have no spans; repeated rows and null keys keep a
    row each; an empty table gives none. Other columns are not read.
    """
    scanned = scan(docs, key, text, owner, repository)
    every = scanned.select("uid", "owner", F.coalesce("repository", F.concat(F.lit("#"), F.col("uid").cast("string"))).alias("repository"),
                           F.explode("spans").alias("s")).select("uid", "owner", "repository", "s.*")
    known = materialize(ownership(every).where("reported or owners = 1"))
    # A candidate that is neither reported nor of one owner gets no span, so its value need not be looked up.
    hot = hot_keys(known, "hash", "mentions", min_hot_rows)
    told = lookup_join(every.select("uid", "start", "kind", "end", "hash", "live", "mixed"),
                       known.select("hash", "owners", "repositories", "reported"), "hash", "uid", hot)
    many = (F.col("repositories") >= copied[0]) & (F.col("owners") >= copied[1])
    state = F.when(many, "copied").when(F.col("live"), "live").otherwise("plain")
    kept = told.withColumn("state", state).where(
        (F.col("kind") < FOUND) | ((F.col("state") == "live") & (F.col("reported") | (F.col("mixed") & (F.col("owners") == 1)))))
    listed = kept.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
        "start", "kind", "end", "owners", "repositories", "state"))).alias("found"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,owners:bigint,repositories:bigint,state:string>>")
    return (scanned.select("uid", "key").join(listed, "uid", "left")
            .select(F.col("key").alias(key), F.coalesce("found", none).alias("spans")))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in [*KINDS, "found"]])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
