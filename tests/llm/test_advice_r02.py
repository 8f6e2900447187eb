"""Cases of the second review: what was left out before is found now."""

import sys
from pathlib import Path
from random import Random

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402


def test_near_copies_go(spark):
    """Texts at a Jaccard similarity of 0.8 and more go, those below stay."""
    draw = Random(6)
    words = lambda n: ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    edited = lambda base, *at: [f"new{i}" if i in at else w for i, w in enumerate(base)]
    base, other = words(100), words(100)
    docs = [(1, base), (2, edited(base, 30, 70)), (3, edited(base, 20, 40, 60, 80)), (4, other), (5, edited(other, 50)),
            (6, edited(other, 2)), (7, []), (8, []), (9, ["a", "b"]), (10, ["A", "b"]), (None, base)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 7, 9]
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0


def test_notices_below_a_heading_that_names_them():
    from lockweir.llm import licenses

    templates = [licenses.Template.of(*x) for x in licenses.LICENSES]
    texts = dict(licenses.LICENSES)

    def found(text, name):
        words = licenses.words_of(text)
        return [(a, b) for t, a, b, _ in licenses.scan_words(words, templates, 0.8, 0.5) if t.name == name]

    tail = " Some words follow here, version 3 of the work, under a public license or none."
    for heading, name in (
        ("GNU General Public License, version 3. ", "GPL-3.0 line"),
        ("Creative Commons Attribution 4.0 International License ", "CC-BY-4.0 line"),
        ("The Software and this permission notice: conditions, rights, copies, persons, documentation, merge, publish, "
         "distribute, sublicense, sell, copyright, portions, substantial, files, charge, granted, person. ", "MIT"),
    ):
        n, size = len(licenses.words_of(heading)), len(licenses.words_of(texts[name]))
        for after in ("", tail, " " + heading):
            assert found(heading + texts[name] + after, name) == [(n, n + size - 1)]
        edited = texts[name].replace(" is ", " has been ").replace(" the ", " a ", 1)
        assert len(found(heading + edited + tail, name)) == 1
    assert found("Released under the MIT License. " * 50, "MIT line") == [(5 * i, 5 * i + 4) for i in range(50)]


def test_names_at_sentence_starts_and_other_case(spark):
    from lockweir.llm import decontamination

    ask = "{a} has {n} apples. {b} gives {a} {m} apples. How many apples does {a} have?"
    item = ask.format(a="Alice", b="Bob", n=5, m=3)
    mixed = "If Anna buys 12 apples and sells them to Bob Miller for 5 euros, how much does Anna Miller get in 0 days?"
    docs = [(1, "Intro. " + ask.format(a="Carol", b="Dave", n=7, m=2)), (2, item.upper()), (3, item.lower()),
            (4, ask.format(a="Carol", b="Dave", n=7, m=2).replace("does Carol", "does Erin")), (5, mixed.upper()), (6, mixed),
            (7, "Eve has 7 pears. Dave gives Eve 2 plums. How many grapes does Eve have?")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, mixed)], "item_id long, text string")
    out = {(r.doc_id, r.item_id): r.verbatim for r in decontamination.contaminated(df, bench).collect()}
    assert out == {(1, 1): False, (2, 1): True, (3, 1): True, (5, 2): True, (6, 2): True}
