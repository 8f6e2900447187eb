"""What must hold at any size: costs in proportion, exchanges on split keys, no caps, no silent folders."""

import time

import pytest
from pyspark.sql import functions as F

from lockweir import session
from lockweir.functions.arrays import part, prefix, text_chunks
from lockweir.operators import budgets, cache, guardrails, pii
from lockweir.operators.analytics import user_stats
from lockweir.operators.masking import mask, unmask


def _seconds(spark, n):
    text = " ".join(f"user{i}@example.com or" for i in range(n))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    done = mask(pii.with_entities(df), "doc_id").select(F.size("spans"), F.length("masked_text"))
    start = time.time()
    assert done.first()[0] == n
    return time.time() - start


def test_detection_and_masking_grow_with_the_spans(spark):
    _seconds(spark, 1000)
    few, many = _seconds(spark, 16_000), _seconds(spark, 32_000)
    assert many < 3.5 * few + 1 and many < 20


def test_masked_text_of_a_long_text(spark):
    text = "é" * 5000 + " a@b.com " + "ß" * 9000 + " c@d.org" + "x" * 10
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = mask(pii.with_entities(df), "doc_id").first()
    want, at = "", 0
    for s in row.spans:
        want += text[at : s.start] + f"<EMAIL:{row.session_id}:EMAIL_{len(row.spans) - 1 - row.spans.index(s)}>"
        at = s.end
    assert row.masked_text == want + text[at:]


def test_prefix_sums_and_parts(spark):
    for n in (0, 1, 127, 128, 129, 1000):
        values = [(i * 7) % 5 for i in range(n)]
        df = spark.createDataFrame([(values,)], "v array<int>")
        got = df.select(prefix(F.col("v"), lambda a, b: a + b).alias("s"), prefix(F.col("v"), lambda a, b: F.greatest(a, b)).alias("m")).first()
        assert got.s == [sum(values[: i + 1]) for i in range(n)]
        assert got.m == [max(values[: i + 1]) for i in range(n)]
    text = "".join(chr(97 + i % 26) for i in range(10_000))
    df = spark.createDataFrame([(text, a, b) for a, b in ((0, 0), (0, 1), (4095, 4097), (4096, 8192), (10, 9999), (9999, 10_000))], "t string, a int, b int")
    assert all(r.p == text[r.a : r.b] for r in df.withColumn("p", part(text_chunks(F.col("t")), F.col("a"), F.col("b"))).collect())


def test_merging_many_overlapping_clusters(spark):
    spans = [("A", "x", 10 * i, 10 * i + 8, 0.5) for i in range(600)] + [("B", "y", 10 * i + 5, 10 * i + 9, 0.9) for i in range(0, 600, 2)]
    df = spark.createDataFrame([(spans,)], f"e {pii.SPAN_ARRAY}")
    got = df.select(pii.merge_spans("e").alias("m")).first().m
    kept = []
    for s in sorted(spans, key=lambda s: s[2]):
        if not kept or s[2] >= kept[-1][3]:
            kept.append(s)
        elif s[4] > kept[-1][4]:
            kept[-1] = s
    assert [tuple(x) for x in got] == kept


def test_each_pattern_is_searched_as_it_stands(spark):
    df = spark.createDataFrame([("say foo bar bb",)], "t string")
    matches = lambda *p: df.select(guardrails.content_matches(F.col("t"), list(p)).alias("m")).first().m
    assert matches(r"(x)\1", r"(b)\1") and matches(".*?foo.*") and not matches(".*+foo") and not matches(r"(x)\1")


def test_more_than_a_thousand_users(spark):
    log = spark.range(1500).select(
        F.col("id").alias("user_id"), F.col("id"), F.lit("openai").alias("provider"), F.lit("m").alias("model"),
        F.lit(1).alias("prompt_tokens"), F.lit(1).alias("completion_tokens"), F.lit(2).alias("total_tokens"),
        F.lit(5).alias("duration_ms"), F.lit(False).alias("cache_hit"), F.lit(False).alias("pii_detected"),
        F.lit("completed").alias("status"), F.lit(0.1).alias("cost_usd"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("request_timestamp"),
    )
    assert user_stats(log, limit=5000).count() == 1500


def test_a_user_is_dealt_by_period_and_bucket(spark):
    log = spark.range(100).select(
        (F.col("id") % 2).alias("user_id"), F.col("id"), F.lit(0.1).alias("cost_usd"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 1000).alias("request_timestamp"),
    )
    limits = spark.createDataFrame([(0, 1.0, "daily")], "user_id long, limit_usd double, period string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = budgets.running_spend(log, limits)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = [line for line in plan.split("\n") if "hashpartitioning(user_id" in line and "_bucket" in line and "period_start" in line]
    assert dealt


def test_few_comparisons_in_the_banded_lookup(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(400, 64))
    side = (vectors @ cache.planes(64, 8, 6, 7) > 0).reshape(400, 8, 6) @ (1 << np.arange(6))
    compared = sum((np.bincount(side[:, b]) ** 2).sum() for b in range(8))
    assert compared < 400 * 400 / 4


def test_admission_rounds_end_in_a_fold(spark):
    log = [(1, i, 1.0 + (i % 7) / 10, 2.0 + ((i * 37) % 11) / 10) for i in range(60)]
    df = spark.createDataFrame(log, "user_id long, id long, cost_usd double, estimated_usd double").withColumn(
        "request_timestamp", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    )
    limits = spark.createDataFrame([(1, 20.0, "monthly")], "user_id long, limit_usd double, period string")
    spend, want = 0.0, {}
    for _, i, cost, estimate in log:
        want[i] = round(spend + estimate, 9) <= 20.0
        spend += cost if want[i] else 0
    for rounds in (1, 2, 40):
        got = {r.id: r.allowed for r in budgets.budget_admission(df, limits, rounds=rounds).collect()}
        assert got == want


def test_texts_without_session_do_not_meet(spark):
    masked = spark.createDataFrame([(1, "", "plain"), (2, None, "none"), (3, "s", "<EMAIL:s:EMAIL_0>")], "doc_id long, session_id string, masked_text string")
    way_back = spark.createDataFrame([("s", "EMAIL_0", "a@b.c")], "session_id string, entity_id string, original string")
    out = {r.doc_id: r.text for r in unmask(masked, way_back).collect()}
    assert out == {1: "plain", 2: "none", 3: "a@b.c"}


def test_no_folder_is_made_up_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
