"""Text forms of durations, costs and token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(x: Column, digits: int) -> Column:
    """Decimal text of a non-negative double, rounded on its exact binary value, ties to even.

    Decimal rounding is right unless the decimal form ends in a 5 at the cut. Then the double is
    scaled to a whole number by a power of two and compared with the midpoint in whole numbers.
    """
    ten = 10**digits
    short = x.cast("decimal(30,12)")
    scaled = short * F.lit(ten).cast("decimal(6,0)")
    k = F.floor(scaled).cast("long")
    power = F.lit(54) - F.floor(F.log2(F.nullif(x, F.lit(0.0)))).cast("int")
    half = F.floor(power / 2).cast("int")
    whole = (x * F.pow(F.lit(2.0), power)).cast("long").cast("decimal(20,0)")
    two_to = lambda n: F.pow(F.lit(2.0), n).cast("long").cast("decimal(20,0)")
    left = whole * F.lit(2 * ten).cast("decimal(6,0)")
    right = (2 * k + 1).cast("decimal(20,0)") * two_to(half) * two_to(power - half)
    up = (left > right) | ((left == right) & (k % 2 == 1))
    kept = (k + up.cast("long")).cast("decimal(20,0)") / F.lit(ten).cast("decimal(6,0)")
    tie = scaled - F.floor(scaled) == F.lit(0.5).cast("decimal(2,1)")
    text = f"decimal(30,{digits})"
    return F.when(tie, kept.cast(text).cast("string")).otherwise(F.round(short, digits).cast(text).cast("string"))


def fmt_duration(ms: Column | str) -> Column:
    ms = _col(ms).cast("long")
    rest = (ms % 60000).cast("double") / 1000
    return (
        F.when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms")))
        .when(ms < 60000, F.concat(fixed(ms.cast("double") / 1000, 2), F.lit("s")))
        .otherwise(
            F.concat(F.floor(ms / 60000).cast("string"), F.lit("m "), fixed(rest, 2), F.lit("s"))
        )
    )


def fmt_cost(cost: Column | str) -> Column:
    cost = _col(cost)
    text = F.when(cost < 0.01, fixed(cost, 4)).when(cost < 1, fixed(cost, 3)).otherwise(fixed(cost, 2))
    return F.concat(F.lit("$"), text)


def fmt_tokens(n: Column | str) -> Column:
    n = _col(n).cast("long")
    return (
        F.when(n < 1000, n.cast("string"))
        .when(n < 1000000, F.concat(fixed(n.cast("double") / 1000, 1), F.lit("K")))
        .otherwise(F.concat(fixed(n.cast("double") / 1000000, 2), F.lit("M")))
    )
