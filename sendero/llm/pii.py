"""Personal data by fixed shapes, and by contexts learned from them; Spark expressions only.

Base shapes find e-mail addresses, IP addresses, card and phone numbers. They are the seeds: the words before a seed
are its lexical patterns. Patterns and the values seen after them form a graph, scored in rounds: a pattern is as
credible for a kind as the share of its values that are of that kind, a value as the patterns that introduce it. Values
with a high score that no base shape found are added as ``found_<kind>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from sendero.llm.arrays import running
from sendero.session import compacted, materialize, table_path

# Kinds in their order, and the shapes. Loops are possessive and starts are anchored so that no long run
# of letters or digits is read more than once; the matches are those of the plain patterns.
KINDS = ["email", "ip", "card", "phone"]
SHAPES = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Digit groups joined by dashes, dots or brackets; no IP address.
GROUPS = r"(?!(?:[0-9]++\.){3}[0-9]++(?![0-9().-]*[0-9]))\(*+[0-9]++(?:[().-]++[0-9]++)*+\)*+"
#: Such groups joined by single blanks too; each stretch between blanks has nothing else in it but marks at its end.
WRITTEN_IN_GROUPS = (r"[^\s0-9@]*+(?<![\p{L}_])" + GROUPS + r"(?:\x20" + GROUPS + r"(?=[^\w\p{L}\s@]*+(?!\S)))++\S*+")
#: What has a digit or an at sign and starts after a blank; a number written in groups is one mention.
MENTION = r"(?<!\S)(?:" + SHAPES["phone"] + "|" + WRITTEN_IN_GROUPS + r"|[^\s0-9@]*+[0-9@]\S*+)"

ROUNDS = 3
CREDIBLE = 0.8
#: Distinct values of a kind that a pattern has to have introduced.
SUPPORT = 5
CONTEXT_CHARS = 80
SPAN = "struct<kind:int,start:int,end:int>"


def located(text: Column, shape: str) -> tuple[Column, Column]:
    """``(values, gaps)``: the matches of a shape and what lies before each and after the last."""
    return F.regexp_extract_all(text, F.lit(shape), F.lit(0)), F.split(text, shape, -1)


def spans_of(values: str, gaps: str) -> Column:
    """Matches as ``(start, end, value)`` in code points, from the lengths of matches and gaps."""
    pairs = F.arrays_zip(F.col(values).alias("value"), F.slice(gaps, 1, F.size(values)).alias("gap"))

    def end(at: Column, pair: Column) -> Column:
        return at + F.length(pair["gap"]) + F.length(pair["value"])

    def span(at: Column, pair: Column) -> Column:
        return F.struct((at + F.length(pair["gap"])).alias("start"), end(at, pair).alias("end"), pair["value"].alias("value"))
    return running(pairs, end, span, "struct<start:int,end:int,value:string>")


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        double = digit * 2
        return total + F.when(i % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]+", "")
    if kind == "ip":
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?(?<=[0-9])(?:\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, row, base, mentions)``: base spans ``(kind, start, end)``, and all mentions with context and kind."""
    rows = docs.select(docs[key].cast("bigint").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("_text"))
    hints = {"email": F.contains("_text", F.lit("@")), "phone": F.contains("_text", F.lit("+")),
             "ip": F.col("_text").rlike(r"[0-9]\.[0-9]"), "card": F.col("_text").rlike("[0-9]"),
             "mention": F.col("_text").rlike("[0-9@]")}
    none = F.array().cast("array<string>")
    for name, shape in [*SHAPES.items(), ("mention", MENTION)]:
        values, gaps = located(F.col("_text"), shape)
        rows = rows.withColumns({f"_{name}": F.when(hints[name], values).otherwise(none),
                                 f"_{name}_gaps": F.when(hints[name], gaps).otherwise(none)})
    rows = rows.select("doc_id", F.xxhash64("_text").alias("row"), "_mention_gaps", *[
        spans_of(f"_{name}", f"_{name}_gaps").alias(f"_{name}") for name in [*SHAPES, "mention"]])

    def checked(number: int, kind: str) -> Column:
        return F.transform(F.filter(f"_{kind}", lambda s: valid(kind, s["value"])), lambda s: F.struct(
            F.lit(number).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    rows = rows.withColumn("base", F.concat(*map(checked, range(len(KINDS)), KINDS)))

    rows = rows.withColumn("_events", _in_order("_mention", "base"))
    parts = F.arrays_zip(F.col("_mention").alias("span"), F.slice("_mention_gaps", 1, F.size("_mention")).alias("gap"),
                         _kinds_before(F.col("_events")).alias("before"),
                         F.reverse(_kinds_after(F.reverse("_events"))).alias("after"))

    def mention(part: Column) -> Column:
        span, before = part["span"], F.lower(F.right(part["gap"], F.lit(CONTEXT_CHARS)))
        words = F.filter(F.split(before, r"\s+"), lambda w: w != "")
        head = F.when(span["value"].rlike(r"^\+[0-9]"), span["value"]).otherwise(F.regexp_extract(span["value"], r"^\S+", 0))
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), span["value"].alias("value"), head.alias("head"),
                        F.slice(F.reverse(words), 1, 2).alias("context"), F.least(part["before"], part["after"]).alias("kind"))
    return rows.select("doc_id", "row", "base", F.transform(parts, mention).alias("mentions"))


def _in_order(mentions: str, base: str) -> Column:
    """Base spans and mentions by start, base spans first where they start together; a mention's kind is that of no span."""
    def event(span: Column, kind: Column) -> Column:
        return F.struct(span["start"].alias("start"), kind.alias("kind"), span["end"].alias("end"))
    return F.sort_array(F.concat(F.transform(base, lambda s: event(s, s["kind"])),
                                 F.transform(mentions, lambda s: event(s, F.lit(len(KINDS))))))


def _kinds(events: Column, start: int, place: str, meets: Callable[[Column, Column], Column]) -> Column:
    """Of each mention, the first kind whose last seen span, known by its ``place``, ``meets`` it; null for none.

    Spans of one kind do not overlap, so of those seen only the last of a kind can reach a mention, and one pass does.
    """
    names = [f"k{kind}" for kind in range(len(KINDS))]

    def advance(at: Column, event: Column) -> Column:
        return F.struct(*[F.when(event["kind"] == kind, event[place]).otherwise(at[name]).alias(name)
                          for kind, name in enumerate(names)])

    def first(at: Column, event: Column) -> Column:
        kinds = [F.when(meets(at[name], event), F.lit(kind)) for kind, name in enumerate(names)]
        return F.struct((event["kind"] == len(KINDS)).alias("mention"), F.coalesce(*kinds).alias("kind"))
    seen = running(events, advance, first, "struct<mention:boolean,kind:int>", F.struct(*[F.lit(start).alias(n) for n in names]),
                   f"struct<{','.join(f'{n}:int' for n in names)}>")
    return F.transform(F.filter(seen, lambda s: s["mention"]), lambda s: s["kind"])


def _kinds_before(events: Column) -> Column:
    """Of each mention, the first kind with a base span that starts no later and ends after its start."""
    return _kinds(events, 0, "end", lambda end, mention: end > mention["start"])


def _kinds_after(backwards: Column) -> Column:
    """Of each mention, the first kind with a base span that starts inside it; events and results from the last one."""
    return _kinds(backwards, 2**31 - 1, "start", lambda start, mention: start < mention["end"])


def score_values(mentions: DataFrame, rounds: int = ROUNDS, credible: float = CREDIBLE,
                 support: int = SUPPORT) -> DataFrame:
    """``(value, kind)``: values that are credible for a kind by their patterns, those found by base shapes left out.

    ``mentions (value, context, kind)``; ``kind`` is null for what no base shape found.
    """
    patterns = F.array(F.get("context", F.lit(0)), F.when(F.size("context") > 1, F.concat_ws(
        " ", F.get("context", F.lit(1)), F.get("context", F.lit(0)))))
    edges = (mentions.select("value", "kind", F.explode(patterns).alias("pattern")).where("pattern is not null")
             .groupBy("pattern", "value").agg(F.max("kind").alias("kind")))
    edges = materialize(edges)
    number = edges.count()
    width = edges.groupBy("pattern").agg(F.count("*").alias("width"))
    seeds = edges.where("kind is not null").select("pattern", "value", "kind", F.lit(1.0).alias("score"))
    scored = None
    for _ in range(rounds):
        known = seeds if scored is None else seeds.unionByName(
            edges.where("kind is null").select("pattern", "value").join(scored, "value")
            .select("pattern", "value", "kind", "score"))
        trusted = (known.groupBy("pattern", "kind").agg(F.sum("score").alias("sum"), F.count("*").alias("n"))
                   .join(width, "pattern").withColumn("trust", F.col("sum") / (F.col("width") + 1))
                   .where((F.col("n") >= support) & (F.col("trust") >= credible)).select("pattern", "kind", "trust"))
        scored = materialize(compacted(
            edges.where("kind is null").select("pattern", "value").join(trusted, "pattern").groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("score")), number))
    best = scored.groupBy("value").agg(F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind"),
                                       F.max("score").alias("score"))
    return best.where(F.col("score") >= credible).select("value", "kind")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, row, spans)`` of every row: spans ``(kind, start, end)`` in code points, end exclusive, sorted.

    Kinds 0 to 3 are base spans of ``KINDS``, kinds 4 to 7 what contexts added for the same kinds. ``row`` is a hash of
    the text, for rows that share a key. Null and empty texts have no spans; null keys and repeated rows keep a row
    each, and null keys get no added spans. Other columns are not read. Texts are read once; what follows works on a
    written table of their mentions. A mention is added if its value is credible, or, for a number written in groups, its
    first stretch; the span is the whole mention in either case.
    """
    path = table_path(docs.sparkSession, "mentions")
    scan(docs, key, text).write.parquet(path)
    scanned = docs.sparkSession.read.parquet(path)
    mentions = scanned.select("doc_id", "row", F.explode("mentions").alias("m")).select("doc_id", "row", "m.*")
    values = score_values(mentions).withColumnRenamed("kind", "by_value")
    heads = (score_values(mentions.select(F.col("head").alias("value"), "context", "kind"))
             .select(F.col("value").alias("head"), F.col("kind").alias("by_head")))
    added = (mentions.where("kind is null").join(values, "value", "left").join(heads, "head", "left")
             .withColumn("kind", F.coalesce("by_value", "by_head")).where("kind is not null").groupBy("doc_id", "row")
             .agg(F.collect_set(F.struct((F.col("kind") + len(KINDS)).alias("kind"), "start", "end")).alias("added")))
    every = F.concat("base", F.coalesce("added", F.array().cast(f"array<{SPAN}>")))
    return scanned.join(added, ["doc_id", "row"], "left").select("doc_id", "row", F.array_sort(every).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"found_{k}") for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first names the stretch."""
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                  s["kind"].alias("kind"))))
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS * 2])

    def piece(at: Column, s: Column) -> Column:
        return F.when(s["start"] >= at, F.concat(F.substr(text, at + 1, s["start"] - at),
                                                 F.element_at(labels, s["kind"] + 1))).otherwise("")
    pieces = running(in_order, lambda at, s: F.greatest(at, s["end"]), piece, "string")
    last = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
    return F.concat(F.array_join(pieces, ""), F.substr(text, last + 1))
