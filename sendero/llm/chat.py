"""Chat formatting in Spark expressions: sort, merge, escape, concatenate, and read back.

Template: ``### <role>: <text>[<and><text>...]</turn>\\n`` per block of adjacent turns of one role. Inside roles and
texts a backslash, ``<``, ``#`` and ``:`` are written as ``\\b``, ``\\l``, ``\\h`` and ``\\c``, so no control string can
stand in a text and every formatted conversation reads back to its turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sendero.llm.arrays import running

# The template's control strings and escapes. The backslash is escaped first and restored last.
OPEN, AFTER_ROLE, BETWEEN, CLOSE = "### ", ": ", "<and>", "</turn>\n"
ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c")]


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _blocks(turns: Column) -> Column:
    """Runs of adjacent turns of one role, as ``(role, texts)``: where runs start, then a slice per start."""
    role = lambda i: F.element_at(turns, i)["role"]
    starts = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (role(i) != role(F.greatest(i - 1, F.lit(1)))))
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.size(turns) + 1))
    return F.transform(F.arrays_zip(starts.alias("first"), ends.alias("end")), lambda s: F.struct(
        role(s["first"]).alias("role"),
        F.transform(F.slice(turns, s["first"], s["end"] - s["first"]), lambda t: t["text"]).alias("texts")))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """``(conv, formatted)``: one formatted text per conversation.

    Turns are ordered by number, nulls first, ties by role and then text. A null text or role counts as empty; repeated
    rows are turns of their own. Rows with a null conversation form one conversation. An empty table gives no rows.
    Other columns are not read. A conversation is one value in the end, so it has to fit a row.
    """
    rows = turns.select(turns[conv].alias(conv), F.struct(
        turns[turn].alias("turn"), escape(F.coalesce(turns[role], F.lit(""))).alias("role"),
        escape(F.coalesce(turns[text], F.lit(""))).alias("text")).alias("_turn"))
    merged = (rows.groupBy(conv).agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
              .select(conv, _blocks(F.col("_turns")).alias("_blocks")))
    written = F.transform("_blocks", lambda b: F.concat(
        F.lit(OPEN), b["role"], F.lit(AFTER_ROLE), F.array_join(b["texts"], BETWEEN), F.lit(CLOSE)))
    return merged.select(conv, F.array_join(written, "").alias("formatted"))


def loss_spans(formatted: DataFrame, role: str = "assistant", conv: str = "conv_id") -> DataFrame:
    """``(conv, formatted, spans)``: where the texts of ``role`` stand, as code points, end exclusive, in order.

    A text is a span of its own also where turns were merged, so the control strings between are under no mask.
    """
    opening = len(OPEN) + len(AFTER_ROLE)
    blocks = F.transform(_written_blocks(F.col("formatted")), lambda b: F.struct(
        _role(b).alias("role"), F.transform(_texts(b), lambda t: F.length(t)).alias("sizes")))

    def pieces(block: Column, i: Column) -> Column:
        first = F.length(block["role"]) + opening + F.when(i == 0, 0).otherwise(len(CLOSE))
        return F.transform(block["sizes"], lambda size, j: F.struct(
            F.when(j == 0, first).otherwise(len(BETWEEN)).alias("gap"), size.alias("size"),
            (block["role"] == escape(F.lit(role))).alias("masked")))

    def span(at: Column, piece: Column) -> Column:
        return F.struct((at + piece["gap"]).alias("start"), (at + piece["gap"] + piece["size"]).alias("end"),
                        piece["masked"].alias("masked"))
    spans = running(F.flatten(F.transform(blocks, pieces)), lambda at, piece: at + piece["gap"] + piece["size"], span,
                    "struct<start:int,end:int,masked:boolean>")
    return formatted.select(conv, "formatted", F.transform(F.filter(spans, lambda s: s["masked"]), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def _written_blocks(formatted: Column) -> Column:
    return F.filter(F.split(formatted, r"\Q" + CLOSE + r"\E", -1), lambda b: b != "")


def _role(block: Column) -> Column:
    return F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)


def _texts(block: Column) -> Column:
    body = F.substr(block, F.lit(len(OPEN) + len(AFTER_ROLE) + 1) + F.length(_role(block)))
    return F.split(body, r"\Q" + BETWEEN + r"\E", -1)


def turns_in(formatted: Column) -> Column:
    """The turns ``(role, text)`` that a formatted conversation holds."""
    return F.flatten(F.transform(_written_blocks(formatted), lambda b: F.transform(
        _texts(b), lambda t: F.struct(unescape(_role(b)).alias("role"), unescape(t).alias("text")))))


def texts_under(formatted: Column, spans: Column) -> Column:
    """The stretches of a formatted conversation under a mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"])))
