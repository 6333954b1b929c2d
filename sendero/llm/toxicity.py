"""Toxicity by a weighted finite-state grammar over clauses.

Small machines read a clause word by word: hostile words carry a weight, a target in the clause raises it, a negation
just before lowers it, and so does speech that is only reported. The machines are composed into one table, and a text
is scored by its matched clauses. The grammar's function words are fixed lists; its hostile words and word stems, and
how clause weights turn into a probability, are learned from labels.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sendero.llm.batches import by_bytes
from sendero.session import compacted, materialize

# The grammar's function words.
THREATS = "kill hurt destroy beat punch shoot stab burn hang attack".split()
TARGETS = "you your yours he his she her they them their people all this".split()
NEGATIONS = "not no never neither nor cannot isnt arent wasnt werent dont doesnt didnt wont without".split()
REPORTS = "said says say wrote writes told tells claimed claims called quoted reported alleged".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLAUSE_END = 8  # added to the class of a word that ends its clause
NEAR = 3  # words that a negation reaches
RAISED, NEGATED, REPORTED, THREATENED = 1.5, 0.25, 0.5, 2.0
STEM = (4, 5, 6)
REPEATS = (2, 3, 4, 6)
AGAIN = "\t"  # between a repeated stem and how often
SAMPLE = 20_000
LEXICON = 5_000
EVIDENCE = 20.0
MEMO_WORDS = 400_000
STRIPPED = re.compile(r"^[\W_]+|[\W_]+$|['’]")


def target(state: int, word: int) -> tuple[int, float]:
    return int(state or word == TARGET), RAISED if word in (INSULT, THREAT) and state else 1.0


def negation(state: int, word: int) -> tuple[int, float]:
    return NEAR if word == NEGATION else max(state - 1, 0), NEGATED if word in (INSULT, THREAT) and state else 1.0


def reported(state: int, word: int) -> tuple[int, float]:
    return int(state or word == REPORT), REPORTED if word in (INSULT, THREAT) and state else 1.0


def hostile(state: int, word: int) -> tuple[int, float]:
    return state, {INSULT: 1.0, THREAT: THREATENED}.get(word, 0.0)


def compose(machines: list, states: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """One machine that runs all of them: ``(next state, output)`` by state and word class; outputs multiply."""
    numbered = {combo: i for i, combo in enumerate(itertools.product(*map(range, states)))}
    after, output = np.zeros((len(numbered), 6), int), np.zeros((len(numbered), 6))
    for combo, i in numbered.items():
        for word in range(6):
            steps = [machine(state, word) for machine, state in zip(machines, combo)]
            after[i, word] = numbered[tuple(s for s, _ in steps)]
            output[i, word] = math.prod(o for _, o in steps)
    return after, output


GRAMMAR = [table.tolist() for table in compose([hostile, target, negation, reported], [1, 2, NEAR + 1, 2])]


class Reader(dict):
    """Word classes by stretch of text between blanks, worked out once per distinct stretch."""

    def __init__(self, weights: dict[str, float]):
        self.once = {f: w for f, w in weights.items() if AGAIN not in f}
        self.again: dict[str, list[tuple[int, float]]] = {}
        for feature, weight in weights.items():
            if AGAIN in feature:
                stem, times = feature.split(AGAIN)
                self.again.setdefault(stem, []).append((int(times), weight))
        self.least = min(weights.values(), default=1.0)
        self.hostile: dict[str, float] = {}
        self.watched: dict[str, list[str]] = {}
        self.functions = ({w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS}
                          | {w: REPORT for w in REPORTS} | {w: THREAT for w in THREATS})

    def __missing__(self, chunk: str) -> int:
        word = bare(chunk)
        own = [word, *stems(word)] if word else []
        weight = max((self.once.get(f, 0.0) for f in own), default=0.0)
        kind = INSULT if weight > 0 else self.functions.get(word, OTHER)
        if kind in (INSULT, THREAT):
            self.hostile[chunk] = weight if weight > 0 else self.least
        if watched := [f for f in own if f in self.again]:
            self.watched[chunk] = watched
        self[chunk] = kind + CLAUSE_END * (chunk[-1:] in ".!?;:")
        return self[chunk]

    def clauses(self, text: str) -> list[float]:
        """The weights of the clauses in which the grammar matches."""
        chunks = text.lower().replace("\n", " . ").split()
        codes = list(map(self.__getitem__, chunks))
        repeated = self._repeated(chunks)
        if not repeated and self.hostile.keys().isdisjoint(chunks):
            return []
        after, output = GRAMMAR
        found, state, total = [], 0, 0.0
        for chunk, code in zip(chunks, codes):
            kind = INSULT if chunk in repeated else code % CLAUSE_END
            if output[state][kind]:
                total += output[state][kind] * max(self.hostile.get(chunk, 0.0), repeated.get(chunk, 0.0))
            state = after[state][kind]
            if code >= CLAUSE_END:
                if total:
                    found.append(total)
                state, total = 0, 0.0
        return found + [total] * (total > 0)

    def _repeated(self, chunks: list[str]) -> dict[str, float]:
        """Weights of the stretches whose stem this text repeats as often as hostile texts do."""
        if self.watched.keys().isdisjoint(chunks):
            return {}
        seen = Counter(c for c in chunks if c in self.watched)
        times: Counter[str] = Counter()
        for chunk, n in seen.items():
            times.update(dict.fromkeys(self.watched[chunk], n))
        reached = {f: max((w for k, w in self.again[f] if n >= k), default=0.0) for f, n in times.items()}
        weights = {c: max(reached[f] for f in self.watched[c]) for c in seen}
        return {c: w for c, w in weights.items() if w > 0}

    def bound(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()
            self.hostile.clear()
            self.watched.clear()


def bare(chunk: str) -> str:
    return STRIPPED.sub("", chunk)


def stems(word: str) -> list[str]:
    return [word[:n] + "*" for n in STEM if len(word) >= n]


def text_features(text: str) -> set[str]:
    """Words and stems of a text, and the stems it repeats with how often at least."""
    words = Counter(w for c in text.lower().split() if (w := bare(c)))
    times: Counter[str] = Counter()
    for word, n in words.items():
        times.update(dict.fromkeys(stems(word), n))
    return {*words, *times, *(f"{f}{AGAIN}{k}" for f, n in times.items() for k in REPEATS if n >= k)}


def learn_weights(labelled: DataFrame) -> dict[str, float]:
    """Log odds of the words and stems that labels speak for, from ``(doc_id, text, toxic)``.

    Kept are those whose documents' labels differ from the rest's with ``EVIDENCE`` (a log-likelihood ratio), at most
    the ``LEXICON`` strongest.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text"):
            rows: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for feature in text_features(text or ""):
                    rows.setdefault(feature, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(rows, pa.string()), "clean": pa.array([c for c, _ in rows.values()], pa.int64()),
                "toxic": pa.array([t for _, t in rows.values()], pa.int64())})
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return {}
    share = n1 / (n0 + n1)
    counts = (labelled.mapInArrow(emit, "feature string, clean bigint, toxic bigint").groupBy("feature")
              .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic > 2"))
    seen = F.col("clean") + F.col("toxic")
    part = lambda n, of: F.when(n > 0, n * F.log(n / (seen * of))).otherwise(0.0)
    scored = counts.select("feature", (2 * (part(F.col("toxic"), share) + part(F.col("clean"), 1 - share))).alias("llr"),
                           F.log((F.col("toxic") + 0.5) / (n1 + 1) / ((F.col("clean") + 0.5) / (n0 + 1))).alias("odds"))
    best = scored.where((F.col("llr") >= EVIDENCE) & (F.col("odds") > 3)).orderBy(F.desc("llr"), "feature")
    return {r["feature"]: r["odds"] for r in best.limit(LEXICON).collect()}


def clause_features(docs: DataFrame, weights: dict[str, float], keep: list[str], text: str = "text") -> DataFrame:
    """``docs``' columns ``keep`` and ``strongest`` and ``summed``, from the weights of the matched clauses."""
    known = docs.sparkSession.sparkContext.broadcast(weights)  # at most LEXICON entries
    kinds = dict(docs.dtypes)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(known.value)
        for batch in by_bytes(batches, "_text"):
            found = [reader.clauses(t or "") for t in batch.column("_text").to_pylist()]
            reader.bound()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array([max(c, default=0.0) for c in found], pa.float64()),
                 pa.array([math.log1p(sum(c)) for c in found], pa.float64())], [*keep, "strongest", "summed"])
    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(
        measure, ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", strongest double, summed double")


def fit_logistic(cells: DataFrame, ridge: float = 0.1, rounds: int = 30) -> list[float]:
    """Ridge-penalised logistic regression by Newton's method; the intercept comes first and is not penalised.

    ``cells (toxic, strongest, summed, n)``, ``n`` rows each. Spark sums a step's slopes and curvatures, so the driver
    gets nine numbers a round, whatever the number of cells. Without cells the coefficients are zeros.
    """
    terms = [F.lit(1.0), F.col("strongest"), F.col("summed")]
    places = [(i, j) for i in range(3) for j in range(i, 3)]
    penalty, beta = np.diag([1e-6, ridge, ridge]), np.zeros(3)
    for _ in range(rounds):
        logit = sum((F.lit(float(b)) * t for b, t in zip(beta, terms)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), logit))))
        sums = [F.sum(F.col("n") * (F.col("toxic") - F.col("_p")) * t) for t in terms]
        sums += [F.sum(F.col("n") * F.col("_p") * (1 - F.col("_p")) * terms[i] * terms[j]) for i, j in places]
        row = np.array([v or 0.0 for v in cells.withColumn("_p", p).agg(*sums).first()])
        curve = np.zeros((3, 3))
        for (i, j), v in zip(places, row[3:]):
            curve[i, j] = curve[j, i] = v
        step = np.linalg.solve(curve + penalty, row[:3] - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-10:
            break
    return np.round(beta, 9).tolist()  # the order in which tasks are summed does not show


def fold(key: str):
    """0, 1 or 2 by the checksum of a key as text; null keys belong to none."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          sample: int = SAMPLE) -> tuple[dict[str, float], list[float]]:
    """``(weights, coefficients)`` from labelled documents outside fold 1: words from fold 0, calibration from fold 2.

    At most ``sample`` labelled rows, those with the smallest key hashes, are used; that bounds what is fitted on, not
    what is scored. Rows without a label of 0 or 1 are left out; of rows repeated with one key all are used,
    counted by Spark, never gathered.
    """
    known = labels.select(labels[key].cast("bigint").alias("_key"), labels[label].cast("int").alias("toxic"))
    chosen = (known.where("toxic in (0, 1) and _key is not null").where(fold("_key") != 1)
              .orderBy(F.xxhash64("_key"), "_key", "toxic").limit(sample))
    texts = docs.select(docs[key].cast("bigint").alias("_key"), docs[text].alias("text"))
    rows = texts.join(F.broadcast(chosen), "_key").withColumn("_fold", fold("_key"))
    weights = learn_weights(rows.where("_fold = 0").select("text", "toxic"))
    cells = materialize(compacted(clause_features(rows.where("_fold = 2"), weights, ["toxic"])
                                  .groupBy("toxic", "strongest", "summed").agg(F.count("*").alias("n")), sample))
    if not weights or cells.isEmpty():
        return weights, [-2.0, 1.0, 0.0]
    return weights, fit_logistic(cells)


def score_toxicity(docs: DataFrame, model: tuple[dict[str, float], list[float]], key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``(key, score)``: the probability of the toxic label for every row's whole text.

    Null and empty texts get the score of a text without a match. Repeated rows and null keys keep a row each. Other
    columns are not read.
    """
    weights, (bias, strongest, summed) = model
    measured = clause_features(docs, weights, [key], text)
    logit = bias + strongest * F.col("strongest") + summed * F.col("summed")
    return measured.select(key, (1 / (1 + F.exp(-logit))).alias("score"))
