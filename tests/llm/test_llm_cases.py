"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import itertools
import sys
from pathlib import Path
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from lockweir.llm import (  # noqa: E402
    chat, components, crc32c, decontamination, licenses, pieces, quality, records, simhash, surrogates, topk, toxicity,
)
from lockweir.llm.settings import byte_tokenizer, piece_model  # noqa: E402

LONG = "lorem ipsum " * 40_000
ODD = [(1, None), (2, ""), (3, " "), (None, "some words here"), (4, "some words here"), (4, "some words here"), (5, LONG)]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd documents, with extra columns whose names clash with results."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    for c in ("score", "ids", "fp", "key", "rank", "component_id", "n_entities", "offending", "hash", "word", "value"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


# 1
def test_surrogates_keep_form_and_refer_alike(spark):
    text = (
        "Mail und.34@mail7.example.com or UND.34@MAIL7.EXAMPLE.COM, call +1 (017) 555-7713 or +10175557713, "
        "card 4111 1111 1111 1111, ip 152.143.123.131### token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff. "
        "Anna Miller and Иван Петров met, Anna left. IBAN TR330006100519786457841326"
    )
    row = surrogates.anonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), "k").first()
    assert row.n_entities == 11
    low, up = row.text.split("Mail ")[1].split(",")[0].split(" or ")
    assert low.upper() == up and low != "und.34@mail7.example.com" and low.endswith(".com")
    a, b = row.text.split("call ")[1].split(", card")[0].split(" or ")
    assert a.replace(" ", "").replace("(", "").replace(")", "").replace("-", "") == b and a.startswith("+1 (")
    card = row.text.split("card ")[1][:19]
    digits = [int(c) for c in card.replace(" ", "")]
    assert sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0
    name = row.text.split(". ")[-2].split()
    assert name[0] == name[-2] and name[0] in surrogates.FEMALE.stand_in.split()
    assert any(n in row.text for n in surrogates.MALE_CYRILLIC.stand_in.split())
    iban = row.text.split("IBAN ")[1]
    turned = iban[4:] + iban[:4]
    assert iban[:2] == "TR" and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1
    other = surrogates.anonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), "another").first()
    assert other.text != row.text


def test_surrogates_collide_never(spark, monkeypatch):
    """With two draws for a number, distinct values still get distinct stand-ins that are no values."""
    drawn = surrogates.surrogate
    few = lambda kind, value, attempt, key: F.when(
        attempt < 3, F.concat(F.lit("999.1.1."), (F.length(value) % 2 + attempt).cast("string"))
    ).otherwise(drawn(kind, value, attempt, key))
    monkeypatch.setattr(surrogates, "surrogate", few)
    ips = [f"10.0.{i}.{j}" for i in range(1, 120, 7) for j in (1, 22)] + ["999.1.1.1"]
    docs = spark.createDataFrame([(i, f"at {ip} end") for i, ip in enumerate(ips)], "doc_id long, text string")
    out = {r.doc_id: r.text.split()[1] for r in surrogates.anonymise(docs, "k").collect()}
    assert len(set(out.values())) == len(ips) and not set(out.values()) & set(ips)


def test_surrogates_odd(odd, none):
    out = surrogates.anonymise(odd, "k")
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted((d or 0, t or "") for d, t in ODD)
    assert out.columns.count("n_entities") == 1 and surrogates.anonymise(none, "k").count() == 0


# 2
def test_topk(spark):
    rng = np.random.default_rng(5)
    data = [(i, [int(x) for x in rng.integers(-9, 9, 6)]) for i in range(300)]
    df = spark.createDataFrame(data + data[:5] + [(None, [1] * 6), (900, None), (901, [])], "id long, vector array<long>")
    df = df.withColumn("score", F.lit("x")).withColumn("n", F.lit("x"))
    for blocks in ((2048, 16384), (7, 64)):
        got = topk.top_k(df.filter("id % 50 = 0"), df, query_block=blocks[0], candidate_block=blocks[1], levels=4)
        want = brute.top_k(data, [d for d in data if d[0] % 50 == 0], 5)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0
    few = spark.createDataFrame(data[:3], "id long, vector array<long>")
    assert topk.top_k(few, few).count() == 6


def test_integer_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, [float("nan"), 1.0]), (3, [None, 1.0]), (4, None), (5, [])], "i int, e array<float>")
    out = {r.i: r.v for r in df.select("i", topk.integer_vector(F.col("e")).alias("v")).collect()}
    assert out == {1: [128, -1], 2: None, 3: None, 4: None, 5: None}


# 3
def test_crc32c():
    assert crc32c.crc32c([b"123456789"])[0] == 0xE3069283
    rng = np.random.default_rng(0)
    strings = [rng.bytes(n) for n in (0, 1, 3, 4, 5, 255, 256, 257, 1023, 5000)]
    assert crc32c.crc32c(strings).tolist() == [brute.crc32c(s) for s in strings]


def test_word_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    encode, plain = records.WordEncoder(byte_tokenizer(), "<u2"), Tokenizer.from_file(byte_tokenizer())
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "é", "42", "!", "<|endoftext|>", "日本", "\r\n", ".", " ", " "]
    draw = Random(1)
    for _ in range(20):
        texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(100)]
        assert [np.frombuffer(b, "<u2").tolist() for b in encode(texts)] == [
            plain.encode(t, add_special_tokens=False).ids for t in texts
        ]


def test_records_read_back_and_by_index(spark, odd, none, tmp_path):
    shards = records.write_records(odd, f"{tmp_path}/r", byte_tokenizer(), shards=3).cache()
    parts = shards.collect()
    out = records.read_digests(shards).orderBy("start").collect()
    assert [r.doc_id for r in out] == [None, 1, 2, 3, 4, 4, 5] and out[1].n_tokens == 1
    assert all(b.start == a.start + a.n_tokens for a, b in zip(out, out[1:]))
    for p in parts:
        for e in spark.read.parquet(f"{p.path}.idx").collect():
            key, ids = records.read_at(p.path, e.offset, e["size"])
            assert key == e.key and len(ids) == e.n_tokens and ids[-1] == 0
    raw = Path(f"{parts[-1].path}.rec")
    data = bytearray(raw.read_bytes())
    data[40] ^= 1
    with pytest.raises(ValueError):
        list(records.read_frames(__import__("io").BytesIO(bytes(data))))
    assert records.read_digests(records.write_records(none, f"{tmp_path}/e", byte_tokenizer())).count() == 0


# 4
def test_patience():
    a, b = "x a b c y d e".split(), "a b z c d e".split()
    assert [a[i] for i, _ in licenses.patience(a, b)] == ["a", "b", "c", "d", "e"]
    draw = Random(2)
    for _ in range(200):
        a, b = ([draw.choice("abcdefgh") for _ in range(draw.randint(0, 15))] for _ in range(2))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert licenses.patience([], list("ab")) == []


def test_licenses(spark, odd, none):
    mit = dict(licenses.LICENSES)["MIT"]
    changed = mit.replace("free of charge", "without any charge").replace("sublicense", "rent")
    twice = "Released under the MIT License. Released under the MIT License."
    docs = [(1, f"intro. {changed} end"), (2, twice), (3, "the mit of the license under"), (4, "Mit der, RELEASED!! under!! THE!! mit!! license")]
    out = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.license): r for r in out}
    assert set(found) == {(1, "MIT"), (2, "MIT line"), (4, "MIT line")} and len(out) == 4
    assert 0.9 < found[1, "MIT"].coverage < 1
    r = found[1, "MIT"]
    assert docs[0][1][r.start : r.end] == changed[:-1]
    assert licenses.scan(odd).count() == 0 and licenses.scan(none).count() == 0 and licenses.scan(odd, []).count() == 0


# 5
def test_chat(spark):
    odd = "\\<|x|> <|end|> \\\\ <\\| <|turn|>user<|text|>"
    turns = [(1, 0, "system", odd), (1, 1, "user", None), (1, 2, "assistant", odd), (1, 3, "assistant", ""), (1, 4, "user", "x"),
             (2, 0, "user", "no reply"), (None, None, None, None), (3, 0, "assistant", "a"), (3, 0, "assistant", "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    examples = chat.expand(df).orderBy("conv_id", "example").collect()
    assert [(r.conv_id, r.example) for r in examples] == [(None, 0), (1, 0), (1, 1), (1, 2), (2, 0), (3, 0), (3, 1)]
    esc = odd.replace("\\", "\\\\").replace("<|", "<\\|")
    assert [r.formatted[r.loss_start : r.loss_end] for r in examples] == ["", esc, "", "", "", "a", "a"]
    parsed = spark.createDataFrame([(examples[3].formatted,)], "f string").select(chat.parse(F.col("f")).alias("t")).first().t
    assert [(t.role, t.text) for t in parsed] == [(r, t or "") for c, _, r, t in turns if c == 1]
    assert chat.expand(df.limit(0)).count() == 0 and chat.digests(chat.expand(df.limit(0))).count() == 0


# 6
def test_quality(spark, odd, none):
    good = [(i, f"These are fine words, number {i}. They make a sentence.") for i in range(200)]
    bad = [(1000 + i, f"###{i} $$$ !!! " * 20) for i in range(200)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(d, int(d < 1000), 0) for d, _ in good + bad] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    stats = quality.with_statistics(docs)
    model = quality.fit(stats, labels, F.lit(True))
    out = {r.doc_id: r.score for r in quality.score(stats, model).collect()}
    assert min(out[d] for d, _ in good) > 0.9 and max(out[d] for d, _ in bad) < 0.1
    scores = quality.score(quality.with_statistics(odd), model).collect()
    assert len(scores) == len(ODD) and all(0 <= r.score <= 1 for r in scores)
    empty = quality.fit(stats, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(stats, empty).collect()} == {0.5}
    assert quality.score(quality.with_statistics(none), model).count() == 0


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    raw = rng.normal(size=3000)
    y = (rng.uniform(size=3000) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    steps, levels = quality.isotonic(raw, y)
    assert (np.diff(levels) >= 0).all() and (np.diff(steps) >= 0).all()
    assert abs(np.interp(0.0, steps, levels) - 0.5) < 0.12


# 7
def test_reparameterised_questions(spark):
    ask = (
        "If {a} buys {n} apples for {p} euros each and sells them to Bob Miller for {q} euros each, "
        "how much profit does {b} make in {m} days?"
    )
    items = [(1, ask.format(a="Anna", b="Anna", n=12, p=3, q=5, m=12)), (2, "tiny one"), (3, None), (4, "")]
    docs = [
        (1, "Intro. " + ask.format(a="Carla", b="Carla", n=40, p=7, q=9, m=40) + " End."),
        (2, ask.format(a="Carla", b="Dora", n=40, p=7, q=9, m=41)),
        (3, items[0][1]), (None, items[0][1]), (3, items[0][1]), (4, None), (5, ""), (6, LONG), (7, "Tiny one. " + items[0][1][:40]),
        (8, items[0][1].upper()),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("hash", F.lit("x"))
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string").withColumn("at", F.lit("x"))
    out = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(df, bench).collect()}
    assert set(out) == {(1, 1), (3, 1), (None, 1), (7, 2), (8, 1)}
    assert out[3, 1].verbatim and not out[1, 1].verbatim and out[1, 1].slots >= 5
    kept = decontamination.without_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]
    assert decontamination.contaminated(df.limit(0), bench).count() == 0
    assert decontamination.contaminated(df, bench.limit(0)).count() == 0


# 8
def test_toxicity(spark, odd, none):
    draw = Random(4)
    word = lambda: "".join(draw.choice(["an", "be", "co", "du", "el"]) for _ in range(3))
    text = lambda bad: ". ".join(" ".join([word() for _ in range(6)] + ([draw.choice(["vile", "awful"])] if bad and k == 3 else [])) for k in range(8))
    docs = [(i, text(i % 5 == 0)) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i, _ in docs] + [(7, 1, None)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(df, labels, F.lit(True))
    assert set(model.weights) == {"vile", "awful"}
    out = {r.doc_id: r for r in toxicity.with_toxicity(df, model).collect()}
    for i, t in docs:
        assert (out[i].score >= 0.7) == (i % 5 == 0)
        for s in out[i].offending:
            assert {"vile", "awful"} & set(t[s.start : s.end].rstrip(". ").split())
        assert len(out[i].offending) == (i % 5 == 0)
    rows = toxicity.with_toxicity(odd, model)
    assert rows.count() == len(ODD) and rows.columns.count("score") == 1 and rows.agg(F.max("score")).first()[0] < 0.7
    blank = toxicity.fit(df, labels.filter("toxic = 0"), F.lit(True))
    assert not blank.weights and toxicity.with_toxicity(none, model).count() == 0


# 9
def test_pieces_are_the_models(spark, odd, none):
    from sentencepiece import SentencePieceProcessor

    sp, vocabulary = SentencePieceProcessor(model_file=piece_model()), pieces.Vocabulary.load(piece_model())
    parts = ["a", "the", "  ", " ", "   ", "\n", "ing", "▁", "²", ".", "².", "é", "ß", "ﬁ", "日本", "x" * 70, "1234", "!!", "_",
             "'", "\t", "\x00", "🙂", "Ünter", "don't", "<s>", "<0x0A>", "aaaaaaa", "क्षि", "ا"]
    draw = Random(1)
    docs = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))) for i in range(800)]
    out = pieces.decode(pieces.encode(spark.createDataFrame(docs, "doc_id long, text string"), vocabulary), vocabulary)
    for r in out.collect():
        assert r.ids == sp.encode(docs[r.doc_id][1]), repr(docs[r.doc_id][1])
        assert r.decoded == docs[r.doc_id][1].replace("▁", " ")
    rows = pieces.decode(pieces.encode(odd, vocabulary), vocabulary).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in rows) == sorted((d or 0, t or "") for d, t in ODD)
    assert pieces.encode(none, vocabulary).count() == 0


def test_best_path_of_a_unigram_model(spark):
    table = [("▁", 1, -3.0), ("a", 2, -2.0), ("b", 3, -2.5), ("ab", 4, -3.2), ("▁a", 5, -2.9), ("ba", 6, -3.9), ("aba", 7, -6.0)]
    vocabulary = pieces.Vocabulary("", table, -1, [], 3, 0)
    words = ["▁" + "".join(x) for n in range(1, 5) for x in itertools.product("abc", repeat=n)]
    known = {p: (i, s) for p, i, s in table}

    def best(word):
        at = {0: (0.0, [])}
        for stop in range(1, len(word) + 1):
            ways = []
            for start in range(max(0, stop - 3), stop):
                piece = word[start:stop]
                if piece in known:
                    ways.append((at[start][0] + known[piece][1], -start, [*at[start][1], known[piece][0]]))
                elif len(piece) == 1:
                    ways.append((at[start][0] - 16.0, -start, [*at[start][1], 0]))
            top = max(ways, key=lambda w: w[:2])
            at[stop] = (top[0], top[2])
        return at[len(word)][1]

    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {r.word: r.ids for r in pieces.encode_words(df, vocabulary, "unigram").collect()} == {w: best(w) for w in words}


# 10
@pytest.mark.parametrize("most", [4, 32, 1000])
def test_links_of_dense_fingerprints(spark, most):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**63))
    values = {base} | {int(x) for x in rng.integers(0, 2**63, 100)}
    while len(values) < 500:
        v = base
        for b in rng.choice(64, size=int(rng.integers(1, 6)), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    signed = {v - (1 << 64) if v >= 1 << 63 else v: v for v in values}
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    want = brute.components(signed)
    sizes = {r: list(want.values()).count(r) for r in set(want.values())}
    got = {r.node: r.root for r in components.components(simhash.links(df, most=most)).collect()}
    assert got == {n: r for n, r in want.items() if sizes[r] > 1}


def test_simhash_odd(odd, none):
    out = simhash.near_duplicates(odd).collect()
    assert sorted((r.doc_id or 0, r.fp, r.component_id) for r in out) == sorted(
        (d or 0, (f := brute.simhash(t)) - (1 << 64 if f >= 1 << 63 else 0), 1 if not (t or "").split() else 5 if d == 5 else 4)
        for d, t in ODD
    )
    assert simhash.near_duplicates(none).count() == 0


def test_components_of_a_long_path(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.components(links).collect()} == {0}
    assert components.components(links.limit(0)).count() == 0
