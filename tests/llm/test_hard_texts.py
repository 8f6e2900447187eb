"""Texts that are hard on patterns: long runs of one kind. They neither overflow a stack nor take long."""

import time

from pyspark.sql import functions as F

from lockweir.llm import decontamination, surrogates


def test_runs_of_names_and_numbers(spark):
    item = "How many apples does the old farmer sell on his third day at the market of the town?"
    docs = [(1, "Alice Bob " * 50_000), (2, "1.2," * 250_000), (3, "a@b" + ".cc" * 300_000), (4, "Ab" * 500_000), (5, "'" * 100_000 + "A's " * 100_000),
            (6, ("X" * 90 + " ") * 10_000 + item), (7, " " * 50_000 + item.upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    bench = spark.createDataFrame([(1, item), (2, "yes"), (3, "Yes.")], "item_id long, text string")
    start = time.time()
    assert sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()) == [(6, 1), (7, 1)]
    assert time.time() - start < 60
    short = spark.createDataFrame([(8, "yes and no"), (9, "YES!")], "doc_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontamination.contaminated(short, bench).collect()) == [(9, 2), (9, 3)]


def test_numbers_that_are_equal_by_chance(spark):
    ask = "Tom buys {} apples and {} pears at the market and eats {} of them with Tom Miller on his way back home."
    bench = spark.createDataFrame([(1, ask.format(5, 5, 2))], "item_id long, text string")
    docs = [(1, ask.format(7, 9, 3)), (2, ask.format(7, 9, 3).replace("Tom buys", "Jim buys").replace("Tom M", "Tom M")), (3, ask.format(7, 9, 3).replace("Tom", "Jim"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r.doc_id: r.verbatim for r in decontamination.contaminated(df, bench).collect()}
    assert out[1] is False and out[3] is False


def test_readings_are_those_of_the_patterns(spark):
    text = "In Paris Texas we met O'Brien, Alice's friend. Yes: Bob Smith ran 5 km (Carl too) in 1,200.50 seconds or 10%. ٣ Été"
    row = spark.createDataFrame([(text,)], "text string").select(decontamination.marked_tokens(F.col("text")).alias("marked"), "text").select(
        decontamination.template_tokens(decontamination.read_tokens(F.col("marked"), decontamination.WITHIN)).alias("within"),
        decontamination.template_tokens(decontamination.read_tokens(F.col("marked"), decontamination.ANYWHERE)).alias("anywhere"),
        decontamination.plain_tokens(F.col("text")).alias("plain"),
        decontamination.template_tokens(F.col("marked")).alias("short"),
    ).first()
    n, u = decontamination.NAME_MARK, decontamination.UNIT_MARK
    assert row.within == ["in", n, "we", "met", "o'brien", n, "friend", "yes", n, "ran", "0", u, "carl", "too", "in", "0", u, "or", "0", u, "0", n]
    assert row.anywhere == [n, "we", "met", "o'brien", n, "friend", n, n, "ran", "0", u, n, "too", "in", "0", u, "or", "0", u, "0", n]
    assert row.short == row.anywhere
    assert row.plain[-8:] == ["too", "in", "1,200.50", "seconds", "or", "10", "٣", "été"]
    assert row.plain[:6] == ["in", "paris", "texas", "we", "met", "o'brien"] and "1,200.50" in row.plain


def test_long_addresses_and_blobs(spark):
    docs = [(1, "a@b" + ".cc" * 300_000), (2, "x9" * 500_000), (3, "mail a.b@c.example.com " + "y." * 300_000), (4, "-" * 1_000_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    start = time.time()
    out = {r.doc_id: r.text for r in surrogates.anonymise(df, "k").collect()}
    assert time.time() - start < 90
    assert "a.b@c.example.com" not in out[3] and out[2] == docs[1][1] and out[4] == docs[3][1]
