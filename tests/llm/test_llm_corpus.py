"""Collocations, repeated strings and spelling variants, against brute force."""

import sys
from pathlib import Path
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from lockweir.llm import collocations, queries, repeats, spelling  # noqa: E402

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 30_000
ODD = [(1, None), (2, ""), (3, " "), (None, "some words here"), (4, "some words here"), (4, "some words here"), (5, LONG)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))
    for c in ("word", "n", "block", "data", "g", "phrase", "rank", "a", "form", "key", "docs", "sizes", "range"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="module")
def documents(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


# 11
@pytest.mark.parametrize("bits", [1, 2, 7, 20, 33, 63, 64])
def test_filters_lose_nothing(bits):
    draw = np.random.default_rng(bits)
    whole, sums = [], {}
    for n in (0, 1, 50, 3000):
        values = np.unique(draw.integers(0, 1 << min(bits, 63), n, dtype=np.uint64))
        if bits == 64:
            values = np.unique(values | np.uint64(1 << 63))
        counts = draw.integers(1, 700, len(values))
        back, same = collocations.decode(collocations.encode(values, counts, bits))
        assert (back == values).all() and (same == counts).all()
        assert (collocations.permute(collocations.permute(values, bits), bits, back=True) == values).all()
        whole.append(collocations.encode(values, counts, bits))
        for v, c in zip(values.tolist(), counts.tolist()):
            sums[v] = sums.get(v, 0) + c
    values, counts = collocations.merge(whole)
    assert dict(zip(values.tolist(), counts.tolist())) == sums and (np.diff(values.astype(object)) > 0).all()


def test_permutation_is_one_to_one():
    for bits in (1, 5, 12):
        assert len(np.unique(collocations.permute(np.arange(1 << bits, dtype=np.uint64), bits))) == 1 << bits


def _collocations(docs, longest=4, least=30, share=80, most=2000):
    import re
    from collections import Counter

    f, n = {}, Counter()
    for lang, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang or "und", Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        some = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in some.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= share * a and inside(q) for q, b in some.items()):
                continue
            score, _, l, r = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:most])]
    return sorted(out)


def test_collocations_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_BLOCK_BYTES", 3_000)
    monkeypatch.setattr(collocations, "_RANGE_TOKENS", 500)
    draw = Random(2)
    words = ["New", "York", "is", "a", "b c", "É", "é", "\U0001f600", "of"]
    docs = [
        (draw.choice(["en", "de", None]), "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r"]) for _ in range(draw.randint(0, 120))))
        for _ in range(150)
    ] + [("en", None), ("fr", ""), ("en", "new york " * 400), ("en", "a " * 3000)]
    df = spark.createDataFrame(docs, "lang string, text string").withColumn("phrase", F.lit("x")).repartition(4)
    for longest, least, most in ((4, 30, 2000), (3, 5, 7), (2, 1, 50)):
        got = collocations.collocations(df, longest=longest, least=least, most=most)
        assert sorted(map(tuple, got.collect())) == _collocations(docs, longest, least, most=most)


def test_collocations_of_odd_tables(odd):
    out = collocations.collocations(odd, least=3).collect()
    assert {r.lang for r in out} == {"und"} and all(r.n == 90_000 + 9 for r in out)
    assert "some words here" in {r.phrase for r in out}
    assert collocations.collocations(odd.limit(0)).collect() == []


# 12
def test_phrases_cover_each_window_once():
    draw = np.random.default_rng(3)
    texts = [draw.integers(0, 3, n).astype(np.uint8) for n in (0, 1, 99, 100, 101, 5000, 0, 700)] + [np.zeros(900, np.uint8)]
    data, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    whole = repeats.phrases(data, sizes)
    for stretch in (128, 1000):
        repeats._STRETCH, kept = stretch, repeats._STRETCH
        try:
            assert all((a == b).all() for a, b in zip(repeats.phrases(data, sizes), whole))
        finally:
            repeats._STRETCH = kept
    slot, at, first, last, _ = whole
    starts = np.r_[0, np.cumsum(sizes)]
    windows = [p for a, b in zip(first, last) for p in range(a, b + 1)]
    assert windows == [p for s, n in zip(starts, sizes) for p in range(s, s + max(0, n - 99))]
    assert ((last <= at) & (at + 32 <= first + 100)).all()


def test_repeats_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_BLOCK_BYTES", 2_000)
    monkeypatch.setattr(repeats, "_RANGE_BYTES", 1 << 12)
    draw = Random(5)
    stock = ["".join(draw.choice("abc ") for _ in range(300)) for _ in range(3)]
    line = "this very common line stands in many documents, each time between others; it has 87 bytes."
    docs = []
    for i in range(120):
        body = ""
        for _ in range(draw.randint(0, 5)):
            a = draw.randint(0, 250)
            body += draw.choice(stock)[a : a + draw.randint(1, 200)]
            body += "".join(draw.choice("xyzé") for _ in range(draw.choice([0, 1, 5, 60])))
            body += draw.choice(["", line])
        docs.append((i, body))
    docs += [(200, "a" * 1000), (201, None), (202, ""), (203, "ab" * 400), (204, "a" * 99), (205, "a" * 100), (206, docs[5][1] + docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, repeats.without_repeats(df).collect())) == sorted(brute.repeats(docs))
    assert sorted(map(tuple, repeats.without_repeats(df, length=40).collect())) == sorted(brute.repeats(docs, 40))
    monkeypatch.setattr(repeats, "_SHARE", 7)
    assert sorted(map(tuple, repeats.without_repeats(df).collect())) == sorted(brute.repeats(docs))


def test_repeats_of_odd_tables(odd):
    body = "one text that is long enough to be told, " * 3 + "the end"
    more = odd.select("doc_id", "text").unionByName(
        odd.sparkSession.createDataFrame([(None, body), (9, body), (9, body)], "doc_id long, text string")
    ).withColumn("block", F.lit("extra"))
    out = repeats.without_repeats(more).collect()
    assert len(out) == len(ODD) + 3
    assert sorted((r.n_removed > 0) for r in out if r.doc_id == 9) == [False, True]
    assert [r.n_removed for r in out if r.doc_id is None and r.n_bytes == len(body)] == [len(body)]
    assert repeats.without_repeats(odd.limit(0)).collect() == []


def test_op12(spark, documents):
    got = queries.QUERIES["op12_prefix_free_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute.repeats(documents))


# 13
def test_scan_finds_all_pairs_at_one_edit():
    for seed in range(400):
        draw = Random(seed)
        words = sorted({"".join(draw.choice("abc") for _ in range(draw.randint(0, 7))) for _ in range(draw.randint(1, 40))})
        head = "x" * draw.randint(0, 2)
        words = [head + w for w in words]
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if _one_edit(words[i], words[j])]
        assert list(spelling.scan(words, len(head), range(len(words)))) == want


def _one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_shares_of_a_list_find_the_same(spark):
    draw = Random(1)
    words = sorted({"abc" + "".join(draw.choice("ab") for _ in range(draw.randint(2, 7))) for _ in range(300)})
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    want = {(a, b) for a in words for b in words if a != b and _one_edit(a, b)}
    for most in (20_000, 7):
        got = [(r.word, r.near) for r in spelling.near_pairs(df, most).collect()]
        assert len(got) == len(want) and set(got) == want


def test_spelling_of_odd_tables(spark, odd):
    docs = [(1, "Planet PLANET planet planet planets plane Ça-Ça çaçaça"), (2, "plonet " * 3 + "planets planets"), (None, "planet×planet ÿÿÿÿÿ"), (3, None), (3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("extra"))
    for one_in, least in ((97, 1), (2, 1), (97, 3)):
        got = {tuple(r) for r in spelling.variants(df, one_in=one_in, least=least).collect()}
        assert got == brute.spelling(docs, one_in=one_in, least=least)
    assert {tuple(r) for r in spelling.variants(odd).collect()} == brute.spelling([(d, t) for d, t in ODD])
    assert spelling.variants(odd.limit(0)).collect() == []


def test_op13(spark, documents):
    got = queries.QUERIES["op13_spelling_variants"](spark, SF).collect()
    assert len(got) == len({r.word for r in got}) and {tuple(r) for r in got} == brute.spelling(documents)
