"""Cases of the third review; rows are built here."""

from __future__ import annotations

import tracemalloc
from pathlib import Path
from random import Random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lockweir.functions import spans
from lockweir.operators import cache, guardrails, pii
from lockweir.sources import request_log


def test_append_writes_a_date_once_not_once_per_task(spark, tmp_path):
    rows = spark.range(0, 400, 1, 16).select(
        "id", F.timestamp_seconds(F.col("id") % 4 * 86_400).alias("timestamp")
    ).withColumn("day", F.to_date("timestamp"))
    path = str(tmp_path / "log")
    for batch in (0, 1, 0):
        request_log.append_batch(rows.filter(F.col("id") % 2 == batch), path, "day", batch)
    files = list(Path(path).rglob("*.parquet"))
    assert len(files) == 4  # each batch has two of the four dates
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(400))


def test_blocks_of_a_lookup_make_a_bounded_number_of_products(spark):
    rng = np.random.default_rng(1)
    n = 3000
    vectors = [v for v in rng.normal(size=(n, 8))]
    queries = pd.DataFrame({"query_id": range(n), "query_us": 10, "asked": vectors, "cells": [np.array([0, 1])] * n})
    entries = pd.DataFrame({"entry_id": range(n), "entry_us": 5, "stored": vectors, "cell": np.arange(n) % 2})
    tracemalloc.start()
    found = cache._best_in_block(100)(queries, entries)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.entry_id.tolist() == list(range(n))
    assert peak < 60 << 20  # one matrix of all products has 72 MB


def test_a_query_moves_once_for_all_cells_of_a_slot(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(200)]
    made = spark.createDataFrame(rows, "id long, embedding array<float>")
    q = made.select(F.col("id").alias("query_id"), "embedding", F.timestamp_seconds(F.col("id") + 1).alias("asked_at"))
    e = made.select(F.col("id").alias("entry_id"), "embedding", F.timestamp_seconds("id").alias("created_at"))
    asked, stored = cache._timed(q, e, 1000)
    asked, _ = cache._in_cells(asked, stored, cache.choose_pivots(e), 0.5)
    assert asked.filter("slot = 0").count() == 200
    unit = np.array([v for _, v in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = {}
    for i in range(200):
        best = int((unit[: i + 1] @ unit[i]).argmax())
        want[i] = best
    assert {r.query_id: r.entry_id for r in cache.cache_lookup(q, e, 0.5, 1000).collect()} == want


def test_checks_look_at_a_candidate_once(spark):
    one = spark.range(1).select(F.lit("12345678901").alias("s"))
    plan = lambda c: one.select(c.alias("v"))._jdf.queryExecution().analyzed().toString()
    assert plan(spans.is_tckn("s")).count("ASCII") == 1  # the digits of a candidate are made plain once
    rule = guardrails.NoPII(entity_types=["TCKN"], name="r")
    entities = F.array().cast(spans.SPAN_ARRAY)
    assert plan(rule.check(F.col("s"), entities, F.lit(1), F.lit(1.0))).count("filter(") == 1


def test_checks_and_positions_are_as_before(spark):
    plain = lambda s: sum(1 for _ in [0] if int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1) == 1
    ibans = ["TR330006100519786457841326", "TR330006100519786457841327", "GB82WEST12345698765432", "TR05", "TR" + "9" * 30, "AB" + "1" * 31]
    rows = spark.createDataFrame([(s,) for s in ibans], "s string").select("s", spans.is_iban("s").alias("ok")).collect()
    assert {r.s: r.ok for r in rows} == {s: plain(s) for s in ibans}
    # The text of the only match stands earlier too, where the pattern does not match.
    text = "x4111111111111111 4111111111111111 😀 " + "a@b.co, aa@b.co"
    got = spark.createDataFrame([(text,)], "text string").select(F.explode(pii.detect_fast("text")).alias("e")).select("e.*").collect()
    assert all(text[r.start:r.end] == r.text for r in got)
    assert [(r.start, r.end) for r in got if r.type == "CREDIT_CARD"] == [(18, 34)]


def test_few_spans_merge_as_many(spark, monkeypatch):
    draw = Random(3)
    lists = []
    for _ in range(60):
        starts = [draw.randrange(60) for _ in range(draw.randrange(1, 16))]
        lists.append(([("A", "t", a, a + draw.randrange(1, 12), draw.choice([0.8, 0.9, 1.0])) for a in starts],))
    df = spark.createDataFrame(lists, f"e {spans.SPAN_ARRAY}")
    merged = lambda: df.select(pii.merge_spans("e").alias("m")).collect()
    few = merged()
    monkeypatch.setattr(pii, "FEW_SPANS", 0)
    assert merged() == few
