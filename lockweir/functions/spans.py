"""Pattern spans with code-point offsets, and the checksum tests (D1-D7), all in Catalyst."""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import let, prefix

# --- fixed values: the six patterns. (?U) makes \d, \b and \s Unicode-aware, and \s is
# widened by the four separators that the JVM does not count as white space.
_S = r"[\s\x1c-\x1f]"
TCKN = r"(?U)\b\d{11}\b"
PHONE = rf"(?U)(\+90{_S}?)?(\(?\d{{3}}\)?[\s\x1c-\x1f.-]?)?\d{{3}}[\s\x1c-\x1f.-]?\d{{2}}[\s\x1c-\x1f.-]?\d{{2}}\b"
EMAIL = r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
IBAN = rf"(?U)\bTR\d{{2}}{_S}?\d{{4}}{_S}?\d{{4}}{_S}?\d{{4}}{_S}?\d{{4}}{_S}?\d{{4}}{_S}?\d{{2}}\b"
CREDIT_CARD = r"(?U)\b\d{4}[\s\x1c-\x1f-]?\d{4}[\s\x1c-\x1f-]?\d{4}[\s\x1c-\x1f-]?\d{4}\b"
AMOUNT = rf"(?Ui)\b\d+[.,]\d{{2}}{_S}*(TL|TRY|USD|EUR|GBP)\b"

# Every decimal digit of Unicode, and the ASCII digit each stands for.
_DIGITS = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_WIDE_DIGITS = "".join(_DIGITS)
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def ascii_digits(s: Column) -> Column:
    return F.when(s.rlike(r"^\p{ASCII}*$"), s).otherwise(F.translate(s, _WIDE_DIGITS, _ASCII_DIGITS))


def _digits(s: Column) -> Column:
    return F.transform(F.split(s, ""), lambda c: c.cast("int"))


def is_tckn(s: Column | str) -> Column:
    """Eleven digits, two of them check digits."""
    s = F.col(s) if isinstance(s, str) else s

    def checked(s: Column) -> Column:
        d = [F.substring(s, i, 1).cast("int") for i in range(1, 12)]
        sums = F.struct((d[0] + d[2] + d[4] + d[6] + d[8]).alias("odd"), (d[1] + d[3] + d[5] + d[7]).alias("even"), d[9].alias("tenth"))
        ok = lambda t: ((t["odd"] + t["even"] + t["tenth"]) % 10 == d[10]) & (F.pmod(t["odd"] * 7 - t["even"], F.lit(10)) == t["tenth"])
        return F.when(s.rlike("^[0-9]{11}$"), let(sums, ok)).otherwise(F.lit(False))

    return let(ascii_digits(s), checked)


def is_iban(s: Column | str) -> Column:
    """Mod-97 test of an account number; blanks are ignored, other separators fail."""
    s = F.col(s) if isinstance(s, str) else s

    def checked(s: Column) -> Column:
        turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))
        # Fold the digits of each character into the remainder; no long number is built.
        remainder = F.aggregate(
            F.split(turned, ""),
            F.lit(0),
            lambda r, c: F.when(
                c.between("0", "9"), (r * 10 + c.try_cast("int")) % 97
            ).otherwise((r * 100 + F.ascii(c) - F.lit(55)) % 97),
        )
        # Two letters before at most 30 digits, as nearly always: the number fits a decimal of 34 digits.
        letter = lambda i: (F.ascii(F.substring(s, i, 1)) - F.lit(55)).cast("string")
        number = F.concat(F.substring(s, 5, 28), letter(1), letter(2), F.substring(s, 3, 2)).cast("decimal(34,0)")
        return (
            F.when(s.rlike(r"^[A-Z]{2}[0-9]{2,30}\z"), number % F.lit(97).cast("decimal(34,0)") == 1)
            .when(s.rlike("^[0-9A-Z]{4,}$"), remainder == 1).otherwise(F.lit(False))
        )

    return let(F.upper(F.translate(ascii_digits(s), " ", "")), checked)


def is_luhn(s: Column | str) -> Column:
    """Luhn test; white space and dashes are ignored."""
    s = F.col(s) if isinstance(s, str) else s
    s = F.regexp_replace(ascii_digits(s), r"(?U)[\s\x1c-\x1f-]", "")
    weighed = F.transform(
        _digits(F.reverse(s)),
        lambda d, i: F.when(i % 2 == 0, d).when(d * 2 < 10, d * 2).otherwise(d * 2 - 9),
    )
    total = F.aggregate(weighed, F.lit(0), lambda acc, x: acc + x)
    return F.when(s.rlike("^[0-9]+$"), total % 10 == 0).otherwise(F.lit(False))


@dataclass(frozen=True)
class Detector:
    """One entity type: its pattern, an optional test, and a cheap test any match implies."""

    type: str
    pattern: str
    valid: Callable[[Column], Column] | None = None
    hint: Callable[[Column], Column] | None = None


_has_digit = lambda t: t.rlike(r"(?U)\d{2}")

DETECTORS = [
    Detector("TCKN", TCKN, is_tckn, _has_digit),
    Detector("PHONE", PHONE, None, _has_digit),
    Detector("EMAIL", EMAIL, None, lambda t: t.contains("@")),
    Detector("IBAN", IBAN, is_iban, lambda t: t.rlike(r"(?U)TR\d")),
    Detector("CREDIT_CARD", CREDIT_CARD, is_luhn, _has_digit),
    Detector("AMOUNT", AMOUNT, None, lambda t: t.rlike(r"(?U)\d[.,]\d{2}")),
]

SPAN_ARRAY = "array<struct<type:string,text:string,start:int,end:int,confidence:double>>"


def _empty() -> Column:
    return F.array().cast(SPAN_ARRAY)


def pattern_spans(text: Column, pattern: str, entity_type: str, valid=None, hint=None) -> Column:
    """All non-overlapping matches of a pattern as spans, those failing ``valid`` left out.

    Spark returns the matches and the text between them but no positions: match ``i`` ends after
    gaps and matches ``0..i``, a running sum. A text without a match costs the hint, or at most one
    search.
    """

    def span(match: Column, start: Column, stop: Column) -> Column:
        return F.struct(
            F.lit(entity_type).alias("type"), match.alias("text"), start.alias("start"), stop.alias("end"),
            F.lit(1.0).alias("confidence"),
        )

    def several(matches: Column) -> Column:
        sizes = F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)),
            matches,
            lambda gap, match: F.length(gap) + F.length(match),
        )
        return F.zip_with(
            matches,
            prefix(sizes, lambda a, b: a + b),
            lambda match, stop: span(match, stop - F.length(match), stop),
        )

    def spans(matches: Column) -> Column:
        # A match alone whose text the text holds once stands where that is found, without a second search by pattern.
        def only(match: Column) -> Column:
            at = lambda pos: F.array(span(match, pos - 1, pos - 1 + F.length(match)))
            once = lambda pos: F.when(F.call_function("locate", match, text, pos + 1) == 0, at(pos)).otherwise(several(matches))
            return let(F.call_function("locate", match, text, F.lit(1)), once)

        return F.when(F.size(matches) == 1, let(F.get(matches, F.lit(0)), only)).otherwise(several(matches))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, spans(m)).otherwise(_empty()))
    if valid is not None:
        found = F.filter(found, lambda s: valid(s["text"]))
    return F.when(F.lit(True) if hint is None else hint(text), found).otherwise(_empty())
