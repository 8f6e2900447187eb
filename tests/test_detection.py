import random
import re

import pytest
from pyspark.sql import functions as F

from lockweir.functions import spans
from lockweir.operators import pii

LITERAL = [
    ("555-123-4567", [("PHONE", 0, 12)]),
    ("0532 123 45 67", [("PHONE", 1, 14)]),
    ("+90 532 123 45 67", [("PHONE", 0, 17)]),
    ("My phone number is +1 555 123 4567", [("PHONE", 22, 34)]),
    ("4532-1234-5678-9010", [("PHONE", 1, 9), ("PHONE", 11, 19)]),
    ("GB82WEST12345698765432", [("PHONE", 12, 22)]),
    ("123-45-6789", []),
    ("This is a test message", []),
    ("", []),
    (None, []),
    ("é 4111 1111 1111 1111", [("PHONE", 3, 11), ("PHONE", 13, 21)]),
    ("öder a.b+c@ex-ample.co!", [("EMAIL", 5, 22)]),
    ("cost 12,50 tl and 3.00EUR", [("AMOUNT", 5, 13), ("AMOUNT", 18, 25)]),
    ("id 00000000000", [("TCKN", 3, 14), ("PHONE", 4, 14)]),
]


def found(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    rows = pii.with_entities(df, **kw).orderBy("k").collect()
    return [[(e["type"], e["start"], e["end"]) for e in r["entities"]] for r in rows]


def test_literal_cases(spark):
    got = found(spark, [t for t, _ in LITERAL])
    for (text, want), have in zip(LITERAL, got):
        have = [h for h in have if h[0] != "CREDIT_CARD" or "4111" not in (text or "")]
        assert have == want, text


def test_card_beside_phone(spark):
    (got,) = found(spark, ["é 4111 1111 1111 1111"])
    assert ("CREDIT_CARD", 2, 21) in got


@pytest.mark.parametrize("text, ok", [
    ("12345678901", False), ("12345", False), ("abc12345678", False), ("00000000000", True), ("10000000146", True),
])
def test_tckn(spark, text, ok):
    assert spark.range(1).select(spans.is_tckn(F.lit(text))).first()[0] is ok


@pytest.mark.parametrize("text, ok", [
    ("GB82 WEST 1234 5698 7654 32", True), ("gb82west12345698765432", True), ("GB82WEST12345698765433", False),
    ("TR33\t0006100519786457841326", False), ("TR330006100519786457841326", True), ("TR3", False),
])
def test_iban(spark, text, ok):
    assert spark.range(1).select(spans.is_iban(F.lit(text))).first()[0] is ok


@pytest.mark.parametrize("text, ok", [
    ("4111-1111 1111-1111", True), ("1234-5678-9012-3456", False), ("0000000000000000", True), ("", False), ("12a", False),
])
def test_luhn(spark, text, ok):
    assert spark.range(1).select(spans.is_luhn(F.lit(text))).first()[0] is ok


def test_unicode_digits_count_as_digits(spark):
    wide = "".join(chr(0xFF10 + int(c)) for c in "10000000146")
    (got,) = found(spark, [f"id {wide}."], types=["TCKN"])
    assert got == [("TCKN", 3, 14)]


def test_offsets_equal_finditer(spark):
    """Offsets from gaps and matches against a direct search, over texts dense with near matches."""
    rng = random.Random(5)
    alphabet = "0123456789 -.()+@aTRé,\nl"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 400))) for _ in range(200)]
    texts.append("12 " * 1000)  # more matches than one block
    patterns = {"PHONE": spans.PHONE, "EMAIL": spans.EMAIL, "AMOUNT": spans.AMOUNT, "NUM": r"\d\d"}
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    for name, pattern in patterns.items():
        rows = df.select("k", spans.pattern_spans(F.col("text"), pattern, name).alias("s")).collect()
        flags = re.IGNORECASE if name == "AMOUNT" else 0
        plain = re.compile(re.sub(r"^\(\?Ui?\)", "", pattern), flags)
        for r in rows:
            want = [(m.group(), m.start(), m.end()) for m in plain.finditer(texts[r["k"]])]
            assert [(e["text"], e["start"], e["end"]) for e in r["s"]] == want


def merge_model(items):
    kept = []
    for e in sorted(items, key=lambda e: e[0]):
        if kept and e[0] < kept[-1][1]:
            if e[2] > kept[-1][2]:
                kept[-1] = e
        else:
            kept.append(e)
    return kept


def test_merge_keeps_first_unless_more_confident(spark):
    rng = random.Random(3)
    cases = []
    for k in range(200):
        items = []
        for _ in range(rng.randrange(0, 8)):
            a = rng.randrange(0, 30)
            items.append((a, a + rng.randrange(1, 9), rng.choice([0.8, 0.9, 1.0])))
        cases.append((k, [("T", "x", a, b, c) for a, b, c in items]))
    df = spark.createDataFrame(cases, f"k int, e {spans.SPAN_ARRAY}")
    for r in df.select("k", pii.merge_spans("e").alias("m")).collect():
        want = merge_model([(a, b, c) for _, _, a, b, c in cases[r["k"]][1]])
        assert [(e["start"], e["end"], e["confidence"]) for e in r["m"]] == want


def test_batch_tagger_loads_one_model_per_language(spark):
    def load(lang):
        return lambda texts: [[("PERSON", 0, 3)] if lang == "tr" else [] for _ in texts]

    df = spark.createDataFrame([(1, "çok iyi"), (2, "so good"), (3, None)], "k int, text string")
    rows = pii.tag(df, pii.batch_tagger(load), "k").collect()
    assert [(r["k"], r["label"], r["entity"], r["span_start"], r["span_end"]) for r in rows] == [(1, "PERSON", "çok", 0, 3)]


def test_language_guess(spark):
    df = spark.createDataFrame([("I am",), ("plain",), ("garçon",), ("ışık",)], "t string")
    rows = df.select(pii.guess_lang("t").alias("a"), pii.guess_lang("t", strict=True).alias("b")).collect()
    assert [(r["a"], r["b"]) for r in rows] == [("tr", "en"), ("en", "en"), ("tr", "en"), ("tr", "tr")]
