"""Personal data, toxicity, decontamination and chat formatting, against brute force and planted cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sendero.llm import chat, decontaminate, pii, queries, toxicity
from tests.llm.conftest import EDGE_TEXTS

# The base patterns as the contract states them.
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, shape in BASE.items() for m in re.finditer(shape, text or "")
            if passes(kind, m.group())]


def test_base_spans_of_random_texts(spark):
    random.seed(3)
    parts = ["a", "b.c", "@", "1", "12", "255", "256", "007", "0", ".", ".", "-", " ", "+1", "(", "4111 1111 1111 1111",
             "4111111111111111", "x@y.z", "é", "\n", "+49 30 1234567", "1.2.3.4", "_", "%", "😀"]
    texts = {i: "".join(random.choices(parts, k=random.randint(1, 14))) for i in range(3000)}
    texts |= {9000: None, 9001: "", 9002: "1" * 50_000, 9003: "a" * 50_000, 9004: "a.b@c" + ".d" * 20_000, 9005: "1 " * 1000}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = pii.scan(df).select("doc_id", pii.written(F.array_sort("base")).alias("spans"))
    assert {r.doc_id: r.spans for r in found.collect()} == {k: ",".join(base_spans(t)) for k, t in texts.items()}


def test_a_mention_takes_the_first_kind_that_meets_it(spark):
    random.seed(11)
    parts = ["a", "b.c", "@", "12", "255", ".", "-", " ", " ", "+1", "(", "4111 1111 1111 1111", "4111111111111111", "x@y.z",
             "+49 30 1234567", "1.2.3.4", "\n", "947 555-0035", "1.2.3.4@x.y"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(1, 14)))) for i in range(3000)]
    scanned = pii.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    met = 0
    for row in scanned:
        for m in row.mentions:
            kinds = [b.kind for b in row.base if b.start < m.end and b.end > m.start]
            met += len(set(kinds)) > 1
            assert m.kind == min(kinds, default=None)
    assert met > 100 and any(len(r.mentions) > 2 for r in scanned)


def test_many_addresses_in_one_text(spark):
    text = " ".join(f"user{i}@mail{i % 9}.org" for i in range(20_000))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    start = time.monotonic()
    found = pii.find_personal_data(df).select(pii.written(F.col("spans")).alias("spans")).first().spans
    assert time.monotonic() - start < 30
    assert found == ",".join(base_spans(text))


def test_contexts_find_what_shapes_miss(spark):
    rows = [(i, f"filler {i % 7} my number is {'+1 947 555 %04d' % i if i < 30 else '947 555-%04d' % i} thanks") for i in range(40)]
    rows += [(100 + i, f"the year was 19{10 + i} here") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.find_personal_data(df).join(df, "doc_id").select(
        "doc_id", pii.written(F.col("spans")).alias("spans"), pii.redact(F.col("text"), F.col("spans")).alias("text"))
    got = {r.doc_id: (r.spans, r.text) for r in found.collect()}
    assert got[3] == ("phone:22:37", "filler 3 my number is [PHONE] thanks")
    assert got[35] == ("found_phone:22:34", "filler 0 my number is [PHONE] thanks")
    assert all(got[100 + i][0] == "" for i in range(30))


def test_found_numbers_are_redacted_whole(spark):
    shown = ["947 555-%04d", "(947) 555-%04d", "947 555 %04d,", "947.555 (%04d)"]
    rows = [(i, f"my number is +1 947 555 {i:04d} thanks") for i in range(30)]
    rows += [(100 + i, f"my number is {shown[i] % i} thanks") for i in range(4)]
    rows += [(200, "my number is 947 5th street"), (201, "see 947, 20 times. 30 of x1 2 at 10.0.0.1 5")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.find_personal_data(df).join(df, "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("text"))
    got = {r.doc_id: r.text for r in found.collect()}
    assert all(got[100 + i] == "my number is [PHONE] thanks" for i in range(4))
    assert got[200] == "my number is [PHONE] 5th street"
    seen = pii.scan(df.where("doc_id = 201")).select(F.transform("mentions", lambda m: m["value"]).alias("v")).collect()[0].v
    assert seen == ["947,", "20", "30", "x1", "2", "10.0.0.1", "5"]


def test_spaced_cards_are_values_of_their_own(spark):
    cards = [c for c in (f"4111 1111 1111 {n}" for n in range(1100, 1200)) if passes("card", c)]
    rows = [(i, f"pay with {c} now") for i, c in enumerate(cards)] + [(50, "pay with 4111 1111 1111 1112 now")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in pii.find_personal_data(df).select("doc_id", pii.written(F.col("spans")).alias("spans")).collect()}
    assert got == {i: "card:9:28" for i in range(10)} | {50: "found_card:9:28"}


def test_personal_data_of_edge_cases(edge_docs, no_docs):
    got = pii.find_personal_data(edge_docs)
    assert sorted((r.doc_id or 0, len(r.spans)) for r in got.collect()) == sorted((k or 0, 0) for k, _ in EDGE_TEXTS)
    assert pii.find_personal_data(no_docs).count() == 0


def test_redaction_of_overlaps(spark):
    df = spark.createDataFrame([("abcdefghij", [(2, 6, 9), (0, 1, 4), (1, 3, 7)]), ("é1", [(0, 1, 2)]), (None, [])],
                               "t string, s array<struct<kind int, start int, end int>>")
    assert [r[0] for r in df.select(pii.redact(F.col("t"), F.col("s"))).collect()] == ["a[EMAIL]j", "é[EMAIL]", None]


def test_personal_data_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op1_contextual_pii(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for key, text in documents:
        base = base_spans(text)
        assert got[key].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[key][f"n_{k}"] for k in BASE] == [sum(b.startswith(k) for b in base) for k in BASE]
        assert got[key].spans.startswith(",".join(base))


def test_grammar_scores_clauses_not_words():
    reader = toxicity.Reader({"glorb": 4.0, "fnar*": 2.0, "mipo*\t3": 3.0})
    plain = reader.clauses("a glorb here.")
    assert plain == [4.0]
    assert reader.clauses("you glorb.") == [4.0 * toxicity.RAISED]
    assert reader.clauses("it is not a glorb.") == [4.0 * toxicity.NEGATED]
    assert reader.clauses("she said a glorb.") == [pytest.approx(4.0 * toxicity.RAISED * toxicity.REPORTED)]
    assert reader.clauses("not. a glorb, fnarling") == [6.0] and reader.clauses("nothing to see") == []
    assert reader.clauses("i will hurt you") == [2.0 * toxicity.THREATENED]
    assert reader.clauses("mipoa mipob. mipoc") == [6.0, 3.0] and reader.clauses("mipoa mipob") == []


def test_toxicity_of_edge_cases(spark, edge_docs, no_docs):
    model = ({"glorb": 4.0}, [-2.0, 1.0, 0.0])
    got = toxicity.score_toxicity(edge_docs, model).collect()
    assert len(got) == len(EDGE_TEXTS) and {round(r.score, 6) for r in got} == {round(1 / (1 + 2.718281828459045**2), 6)}
    assert toxicity.score_toxicity(no_docs, model).count() == 0
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1)], "doc_id bigint, toxic int")
    weights, _ = toxicity.train(edge_docs, labels)
    assert weights == {}


def test_calibration_equals_newtons_steps_on_all_rows(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.exponential(1.0, (400, 2)), 1)
    y = (rng.random(400) < 1 / (1 + np.exp(1.5 - x[:, 0]))).astype(int)
    design, penalty, beta = np.column_stack([np.ones(400), x]), np.diag([1e-6, 0.1, 0.1]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        curve = (design * (p * (1 - p))[:, None]).T @ design + penalty
        beta += np.linalg.solve(curve, design.T @ (y - p) - penalty @ beta)
    rows = spark.createDataFrame([(int(t), float(a), float(b)) for t, (a, b) in zip(y, x)],
                                 "toxic int, strongest double, summed double")
    cells = rows.groupBy("toxic", "strongest", "summed").agg(F.count("*").alias("n"))
    assert cells.count() < 400
    assert toxicity.fit_logistic(cells) == pytest.approx(beta.tolist(), abs=1e-7)
    assert toxicity.fit_logistic(cells.where("n < 0")) == [0.0, 0.0, 0.0]


def test_toxicity_on_held_out_labels(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("aeioulmnrst", k=5)) for _ in range(300)]
    rows = []
    for i in range(900):
        text, toxic = rng.choices(words, k=60), int(i % 9 == 0)
        if toxic:
            text[7:7] = ["you", rng.choice(["glorb", "fnarly", "fnarish"]), rng.choice(["glorb", "zot"])]
        rows.append((i, " ".join(text) + ".", toxic))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(df, toxicity.train(df, df.drop("text"))).collect()}
    held = [(toxic, scored[i] >= 0.7) for i, _, toxic in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(t == p for t, p in held) / len(held) > 0.97 and all(0 <= s <= 1 for s in scored.values())


def test_toxicity_query(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op7_clause_grammar(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7) for k, r in got.items())


ITEM = "A train from Berlin leaves at 6 pm and travels 200 km to reach the city before noon, says Carl today."


@pytest.mark.parametrize("held", [decontaminate.HELD_WINDOWS, 0])
def test_reparameterised_items_are_caught(spark, monkeypatch, held):
    monkeypatch.setattr(decontaminate, "HELD_WINDOWS", held)
    docs = [(1, "Well. " + ITEM.replace("Berlin", "Rome").replace("200", "450").replace("km", "miles")), (2, ITEM), (3, None), (4, ""),
            (5, "A train from Berlin leaves at 6 pm and walks slowly to some other town."), (6, ITEM + " " + ITEM), (None, ITEM), (2, ITEM),
            (7, "word " * 30_000)]
    df = spark.createDataFrame([(k, t, 0, 0) for k, t in docs], "doc_id bigint, text string, item_id int, slots int")
    items = spark.createDataFrame([(9, ITEM), (9, ITEM), (10, "too short"), (11, None), (None, ITEM)], "item_id bigint, text string")
    got = sorted(tuple(r) for r in decontaminate.contaminated(df, items).collect())
    n = len(ITEM.split()) - decontaminate.WINDOW + 1
    assert [(d, i, w) for d, i, _, w, _ in got] == [(1, 9, n), (2, 9, n), (6, 9, n), (6, 9, n)]
    assert [c for *_, c in got] == [3, 0, 0, 0] and got[3][2] - got[2][2] == len(ITEM.split())
    assert decontaminate.contaminated(df.where("doc_id < 0"), items).count() == 0
    assert decontaminate.contaminated(df, items.where("item_id < 0")).count() == 0


def test_slots_have_to_agree(spark):
    twice = "If Anna has 5 apples and gives away 2 of them, then Anna keeps the rest of the 5 apples."
    docs = [(1, twice.replace("Anna", "Bob").replace("5", "8")), (2, twice.replace("then Anna", "then Bob")), (3, twice.replace("the 5", "the 6"))]
    df, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, twice)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_windows, r.n_changed) for r in decontaminate.contaminated(df, items).collect()}
    assert got == {1: (11, 2), 2: (11, 1), 3: (11, 1)}  # windows that hold one of the two places agree in themselves


def test_one_altered_value_spares_no_verbatim_windows(spark):
    twice = "If Anna has 5 apples and gives away 2 of them, then Anna keeps the rest of the 5 apples."
    odd = "If Anna has 5 apples and Anna gives 5 away"
    docs = [(1, twice.replace("the 5", "the 6")), (2, odd.replace("and Anna", "and Bob"))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, twice), (2, odd)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_changed) for r in decontaminate.contaminated(df, items).collect()}
    assert got.keys() == {(1, 1)} and got[1, 1] == (11, 1)


@pytest.mark.parametrize("readings", [decontaminate.READINGS, 4])
def test_names_that_open_sentences_are_names(spark, monkeypatch, readings):
    monkeypatch.setattr(decontaminate, "READINGS", readings)
    short = "Tom has 3 apples. Tom buys 2 more. Tom eats 1 of them. Tom counts what is left."
    ten = "Trains leave the old town at noon and then return"
    docs = [(1, short.replace("Tom", "Eva")), (2, "Puzzles of the week\n" + ten), (3, "so she said: " + ten),
            (4, short.replace("Tom buys", "Eva buys").replace("Tom counts", "Eva counts")), (5, "A. B. C. D. E. F. G. H. I. J. " * 200)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = spark.createDataFrame([(1, short), (2, ten)], "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.n_windows, r.n_changed) for r in decontaminate.contaminated(df, items).collect())
    assert [g for g in got if g[0] != 4] == [(1, 1, 9, 1), (2, 2, 1, 0), (3, 2, 1, 0)]


@pytest.mark.parametrize("size, literal", [(1, 1), (2, 1), (3, 2), (4, 4), (5, 2)])
def test_no_window_with_a_known_reading_is_left_out(size, literal):
    rng = np.random.default_rng(size)
    name, number = decontaminate.PLACEHOLDERS[0], decontaminate.PLACEHOLDERS[1]
    words = rng.integers(1, 2**63, 6, np.uint64)
    kept, left_out = 0, 0
    for _ in range(30):
        n = int(rng.integers(size, 60))
        kinds = rng.choice([decontaminate.WORD, decontaminate.NAME, decontaminate.NUMBER], n, p=[0.8, 0.1, 0.1])
        tokens = np.select([kinds == decontaminate.NAME, kinds == decontaminate.NUMBER], [name, number], rng.choice(words, n))
        either = (kinds == decontaminate.WORD) & (rng.random(n) < 0.4)
        every = [*words, name, number]
        pairs = [(a, b) for a in every for b in every if rng.random() < 0.3]
        left, right = np.array(pairs, np.uint64).T
        held = np.sort(decontaminate.mix(left + right * decontaminate.STEP))
        got = decontaminate.believable(tokens, kinds, either, size, literal, *decontaminate.marks(held))
        assert len(got) == n - size + 1
        for i in range(n - size + 1):
            ways = [[(t, k == decontaminate.WORD), (name, False)] if e else [(t, k == decontaminate.WORD)]
                    for t, k, e in zip(tokens[i:i + size], kinds[i:i + size], either[i:i + size])]
            known = any(sum(w for _, w in way) >= literal and all((a, b) in pairs for (a, _), (b, _) in itertools.pairwise(way))
                        for way in itertools.product(*ways))
            assert got[i] or not known
            kept, left_out = kept + bool(known), left_out + (not got[i])
    assert kept and left_out


@pytest.mark.parametrize("held", [decontaminate.HELD_WINDOWS, 0])
def test_short_and_wordless_items_are_found_as_they_are(spark, monkeypatch, held):
    monkeypatch.setattr(decontaminate, "HELD_WINDOWS", held)
    short, sums, names = "What is 17 times 23?", "3 + 4 = 7 8 - 5 = 3 6 * 2 12 9", "Ada Bo Cy Dee Eli Flo Gus Hal Ivy Jo Kim"
    docs = [(1, "Here: what is 17 times 23? Well."), (2, "What is 17 times 24?"), (3, "so 3 + 4 = 7 8 - 5 = 3 6 * 2 12 9 it is"),
            (4, "so 3 + 4 = 7 8 - 5 = 3 6 * 2 13 8 it is"), (5, f"They are {names}."), (6, f"They are {names}.".replace("Eli", "Eve")),
            (7, "What is 17"), (8, "times 23?"), (9, "23"), (10, None), (11, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2)
    items = spark.createDataFrame([(1, short), (2, sums), (3, names), (4, ""), (5, None), (6, "+ =")], "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.first_token, r.n_changed) for r in decontaminate.contaminated(df, items).collect())
    assert got == [(1, 1, 1, 0), (3, 2, 1, 0), (5, 3, 2, 0)]


def test_decontamination_query(spark, sf_dir, documents):
    items = [(r.item_id, " ".join(r.text.split())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(k, i) for k, t in documents for i, item in items if item in " ".join(t.split())}
    assert {(r.doc_id, r.item_id) for r in queries.op5_template_windows(spark, sf_dir).collect()} == want


TURNS = [(1, 0, "user", "hi <and> there"), (1, 1, "user", "\\### Assistant: </turn> ok"), (1, 2, "assistant", "a\\"), (1, 3, "assistant", ""),
         (1, 4, "assistant", "é😀"), (1, 5, "user", None), (2, 1, "assistant", "x"), (2, 0, "a: b\\b", "y"), (3, None, None, None),
         (3, None, None, None), (None, 0, "user", "z"), (4, 7, "assistant", "q"), (4, 7, "assistant", "p"), (5, 0, "user", "n" * 50_000)]


def test_formatting_reads_back(spark):
    df = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id bigint, turn bigint, role string, text string, formatted string")
    masked = chat.loss_spans(chat.format_conversations(df.repartition(3)))
    got = {r.conv_id: r for r in masked.select("conv_id", "formatted", "spans", chat.turns_in(F.col("formatted")).alias("turns"),
                                               chat.texts_under(F.col("formatted"), F.col("spans")).alias("loss")).collect()}
    by = {}
    for conv, turn, role, text in sorted(TURNS, key=lambda t: tuple((v is not None, v) for v in t)):
        by.setdefault(conv, []).append((role or "", text or ""))
    assert {k: [tuple(t) for t in r.turns] for k, r in got.items()} == by
    assert {k: r.loss for k, r in got.items()} == {k: [x for role, x in ts if role == "assistant"] for k, ts in by.items()}
    assert got[2].formatted == "### a\\c b\\bb: y</turn>\n### assistant: x</turn>\n"
    assert got[1].formatted.count("### ") == 3 and [got[1].formatted[s.start:s.end] for s in got[1].spans] == ["a\\b", "", "é😀"]
    assert chat.format_conversations(df.where("conv_id < 0")).count() == 0


def test_many_turns_in_one_conversation(spark):
    turns = [(1, i, ("user", "assistant", "assistant")[i % 3], f"turn # {i} </turn>") for i in range(20_001)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    start = time.monotonic()
    row = chat.loss_spans(chat.format_conversations(df)).select(
        "formatted", "spans", chat.turns_in(F.col("formatted")).alias("turns")).first()
    assert time.monotonic() - start < 30
    assert [tuple(t) for t in row.turns] == [(r, t) for _, _, r, t in turns]
    assert [row.formatted[s.start:s.end].replace("\\h", "#").replace("\\l", "<") for s in row.spans] == [
        t for _, _, r, t in turns if r == "assistant"]


def test_formatting_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = {}
    for conv, _, role, text in sorted(rows + queries.PLANTED):
        by.setdefault(conv, []).append((role, text or ""))
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op10_chat_format(spark, sf_dir).collect()}
    want = {}
    for conv, turns in by.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        want[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                      hashlib.sha256(loss.encode()).hexdigest())
    assert got == want
