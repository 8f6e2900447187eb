"""Cases of the third review."""

from __future__ import annotations

import re
from random import Random

import brute
import numpy as np

from lockweir.llm import pieces, simhash
from lockweir.llm.settings import piece_model


def test_a_group_of_edited_copies_is_found_with_fingerprints(spark, monkeypatch):
    draw = Random(9)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(7))
    base = [word() for _ in range(110)]
    texts = {}
    for i in range(120):
        copy = list(base)
        for at in draw.sample(range(110), 1 + i % 9):
            copy[at] = word()
        texts[i + 1] = " ".join(copy)
    near = texts[9].split()  # far from most others, but not from each other
    near[50] = word()
    texts[300] = " ".join(near)
    linked, links = [], simhash.links

    def spied(fps, *rest):
        linked.append(fps.count())
        return links(fps, *rest)

    monkeypatch.setattr(simhash, "links", spied)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_copies(df).collect()} == brute.near_copies(texts)
    assert linked and linked[0] > 100  # fingerprints under deletion variants take part


def _odd_texts():
    draw = Random(3)
    word = lambda: "".join(draw.choice("abcdeé ▁字\n,.0😀") for _ in range(draw.randint(1, 9)))
    texts = {i: " ".join(word() for _ in range(draw.randint(0, 30))) for i in range(60)}
    return texts | {60: "", 61: None, 62: "x" * 200 + " 17 " + "y" * 70, 63: texts[5], 64: "a  b   c", 65: "1 2 3 4"}


def test_blocks_of_words_stay_where_they_lie(spark, monkeypatch):
    from sentencepiece import SentencePieceProcessor

    monkeypatch.setattr(pieces, "BLOCK_CHARS", 400)
    model = SentencePieceProcessor(model_file=piece_model())
    texts = _odd_texts()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(2)
    out = pieces.encode(df, pieces.Vocabulary.load(piece_model()))
    assert {r.doc_id: r.ids for r in out.collect()} == {k: model.encode(t or "", out_type=int) for k, t in texts.items()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert "block" not in moved and "word" not in moved  # only packets are shuffled, neither blocks nor rows of words


def test_numbers_by_first_appearance_come_back():
    draw = np.random.default_rng(1)
    for n in (0, 1, 5000):
        order: dict[int, int] = {}
        numbers = np.array([order.setdefault(int(x), len(order)) for x in draw.zipf(1.3, n)], np.int32)
        assert pieces._unpack_numbers(pieces._pack_numbers(numbers)).tolist() == numbers.tolist()
