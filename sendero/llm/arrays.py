"""Array expressions with a running position."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Items of a part, at least; a long array has parts of the square root of its size.
PART = 64


def running(items: Column, advance: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column],
            kind: str, start: Column | None = None, state: str = "int") -> Column:
    """``emit(at, item)`` of every item, ``kind`` by its SQL type; ``at`` starts at 0 and goes on to ``advance(at, item)``.

    ``start`` and ``state``, its SQL type, begin ``at`` with something else than 0. Null items give null.

    Spark copies an accumulator at every step, so none may grow with the array: a first pass notes where each part
    begins, a second goes through each part from there. The work is in proportion to the size times its square root.
    """
    zero = (F.lit(0) if start is None else start).cast(state)

    def over(all_: Column) -> Column:
        size = F.size(all_)
        width = F.greatest(F.lit(PART), F.ceil(F.sqrt(size)).cast("int"))

        def places(first: Column) -> Column:
            return F.sequence(first, F.least(first + width - 1, size))

        def begins(acc: Column, first: Column) -> Column:
            part = F.struct(first.alias("first"), acc["at"].alias("at")).cast(f"struct<first:int,at:{state}>")
            at = F.aggregate(places(first), acc["at"], lambda at, i: advance(at, F.element_at(all_, i)).cast(state))
            return F.struct(at.alias("at"), F.array_append(acc["parts"], part).alias("parts"))

        def emitted(part: Column) -> Column:
            def step(acc: Column, i: Column) -> Column:
                item = F.element_at(all_, i)
                return F.struct(advance(acc["at"], item).cast(state).alias("at"),
                                F.array_append(acc["out"], emit(acc["at"], item).cast(kind)).alias("out"))
            none = F.struct(part["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
            return F.aggregate(places(part["first"]), none, step)["out"]
        first_part = F.struct(zero.alias("at"), F.array().cast(f"array<struct<first:int,at:{state}>>").alias("parts"))
        parts = F.aggregate(F.sequence(F.lit(1), size, width), first_part, begins)["parts"]
        return F.when(size > 0, F.flatten(F.transform(parts, emitted))).when(size == 0, F.array().cast(f"array<{kind}>"))
    return F.flatten(F.transform(F.array(items), over))  # the items are computed once and have a name
