"""Array expressions whose cost stays in proportion to the array.

A fold copies its accumulator at every step, so a fold that gathers an array is quadratic. Here
long arrays are folded in chunks: numbers per chunk, then over the chunks, then inside each chunk.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CHUNK = 128
_TEXT_CHUNK = 4096


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` needs it within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def prefix(values: Column, op: Callable[[Column, Column], Column], zero: int = 0) -> Column:
    """Inclusive running fold of an int array by an associative ``op`` with neutral element ``zero``."""
    start = F.array(F.lit(zero))
    grow = lambda acc, x: F.concat(acc, F.array(op(F.element_at(acc, F.lit(-1)), x)))

    def chunked(vs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(vs) - 1) / _CHUNK).cast("int"))
        part = lambda c: F.slice(vs, c * _CHUNK + 1, _CHUNK)
        totals = F.transform(numbers, lambda c: F.aggregate(part(c), F.lit(zero), op))
        return let(
            F.aggregate(totals, start, grow),
            lambda before: F.flatten(
                F.transform(
                    numbers,
                    lambda c: F.slice(F.aggregate(part(c), F.array(F.get(before, c)), grow), F.lit(2), F.lit(_CHUNK)),
                )
            ),
        )

    def whole(vs: Column) -> Column:
        short = F.slice(F.aggregate(vs, start, grow), F.lit(2), F.greatest(F.size(vs), F.lit(1)))
        return F.when(F.size(vs) <= _CHUNK, short).otherwise(chunked(vs))

    return let(values, whole)


def text_chunks(text: Column) -> Column:
    """A text in pieces of equal length, so that a part far from its start is found without a walk."""
    last = F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / _TEXT_CHUNK).cast("int")
    return F.when(last == 0, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda c: F.substring(text, c * _TEXT_CHUNK + 1, F.lit(_TEXT_CHUNK)))
    )


def part(chunks: Column, start: Column, stop: Column) -> Column:
    """Code points ``start`` to ``stop`` (left out) of a text cut by ``text_chunks``."""
    first = F.floor(start / _TEXT_CHUNK).cast("int")
    last = F.floor(F.greatest(stop - 1, start) / _TEXT_CHUNK).cast("int")
    near = F.array_join(F.slice(chunks, first + 1, last - first + 1), "")
    return F.when(F.size(chunks) == 1, F.substring(F.get(chunks, F.lit(0)), start + 1, stop - start)).otherwise(
        F.substring(near, start - first * _TEXT_CHUNK + 1, stop - start)
    )
