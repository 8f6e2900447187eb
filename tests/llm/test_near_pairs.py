"""Pairs of the near-copy stage in large groups."""

from __future__ import annotations

from random import Random

from lockweir.llm import simhash


def test_members_that_share_much_and_are_not_near_are_no_pairs(spark):
    draw = Random(4)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(7))
    base, texts = [word() for _ in range(120)], {}
    for i in range(150):
        other = list(base)
        for at in draw.sample(range(120), 20):
            other[at] = word()
        texts[i] = " ".join(other)
    for i in range(10):  # each near one of them
        words = texts[i].split()
        words[60] = word()
        texts[200 + i] = " ".join(words)
    sets = {i: simhash.shingle_set(t.encode()) for i, t in texts.items()}
    members = spark.createDataFrame([(0, i, len(s), i) for i, s in sets.items()], "first long, node long, n long, root long")
    rows = spark.createDataFrame(list(texts.items()), "node long, text string")
    pairs = {(r.a, r.b) for r in simhash._pairs_by_difference(members, rows, 0.8, 5).collect()}
    near = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(near) >= 10 and near <= pairs
    assert len(pairs) < 5 * len(near)  # most of the 12,720 pairs share a rare shingle
