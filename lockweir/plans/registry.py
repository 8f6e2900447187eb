"""Every operator as a query over the given tables: ``QUERIES[key](spark, sf_dir)``."""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions import dates, formats, spans, vectors
from ..operators import (
    analytics, attribution, budgets, cache, costs, guardrails, limits, masking, metrics, pii,
    projections, routing, webhooks,
)
from ..session import cut, shared_dir
from ..sources import derived, dims, request_log
from ..streaming import limiter, live, queue
from . import replay as replay_plan
from . import screening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

ASOF = "2024-01-17 09:30:00"


def query(key: str):
    """Register a query. Results take stable types: nine decimals, times without a zone."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(spark, sf_dir)
            shaped = []
            for f in df.schema.fields:
                if isinstance(f.dataType, T.DoubleType):
                    shaped.append(F.round(F.col(f"`{f.name}`"), 9).alias(f.name))
                elif isinstance(f.dataType, T.TimestampType):
                    shaped.append(F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name))
                else:
                    shaped.append(F.col(f"`{f.name}`"))
            return df.select(*shaped)

        QUERIES[key] = run
        return fn

    return register


def at(text: str):
    return F.lit(text).cast("timestamp")


def documents(spark, sf_dir):
    return derived.table(spark, sf_dir, "documents").select("doc_id", "text")


def turns(spark, sf_dir):
    """All conversations; an address is added to every third turn and a valid card number to every fifth."""
    n = F.col("conv_id") + F.col("turn")
    mail = F.when(n % 3 == 0, F.concat(F.lit(" Write to u"), F.col("turn").cast("string"), F.lit("@example.com."))).otherwise("")
    card = F.when(n % 5 == 0, F.lit(" Card 4111-1111-1111-1111.")).otherwise("")
    return derived.table(spark, sf_dir, "conversations").withColumn("text", F.concat("text", mail, card))


def texts(spark, sf_dir):
    # Dealt out while the rows are two numbers: the texts made of them are what costs time.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    probes = derived.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").repartition(parts, "o_orderkey")
    return documents(spark, sf_dir).unionByName(
        derived.probe_texts(probes).select((-1 - F.col("doc_id")).alias("doc_id"), "text")
    )


def found(spark, sf_dir):
    return pii.with_entities(texts(spark, sf_dir))


def requests(spark, sf_dir):
    return derived.requests(spark, sf_dir)


LOG = [
    "id", "user_id", "request_timestamp", "provider", "model", "prompt_tokens", "completion_tokens",
    "total_tokens", "cost_usd", "duration_ms", "cache_hit", "pii_detected", "status",
]


# ------------------------------------------------------------------ sources and sinks
@query("s1")
def _(spark, d):
    return requests(spark, d).select(*LOG)


@query("s2")
def _(spark, d):
    path = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}"
    request_log.append_requests(requests(spark, d), path)
    return request_log.read_requests(spark, path, at("2024-01-10"), at("2024-01-20")).select(*LOG)


@query("s3")
def _(spark, d):
    judged = guardrails.verdict(found(spark, d), None, F.col("text"), F.col("entities"))
    return guardrails.violations_to_log(judged, ["doc_id"])


def _messages(spark, d, rows: DataFrame) -> str:
    """Queue files with one JSON message per row, and one broken copy of every hundredth."""
    path = f"{shared_dir(spark)}/queue-{uuid.uuid4().hex}"
    body = F.to_json(F.struct(*rows.columns))
    broken = F.when(F.pmod(F.xxhash64("id"), F.lit(100)) == 0, F.substring(body, 1, 15))
    rows.select(F.explode(F.filter(F.array(body, broken), lambda m: m.isNotNull())).alias("value")).write.text(path)
    return path


@query("s4")
def _(spark, d):
    base = f"{shared_dir(spark)}/consume-{uuid.uuid4().hex}"
    rows = requests(spark, d).select(
        F.col("id").cast("string").alias("id"), F.col("user_id").cast("string").alias("user_id"),
        F.date_format("request_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("request_timestamp"),
    )
    stream = queue.read_queue(spark, _messages(spark, d, rows))
    queue.consume(
        stream, lambda df, batch: queue.write_batch(df, f"{base}/good", batch), f"{base}/bad", f"{base}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/good").select("id", "user_id", "request_timestamp")


@query("s5")
def _(spark, d):
    return routing.request_text(derived.table(spark, d, "conversations"))


@query("s3_append")
def _(spark, d):
    """The log as it is stored, after one of two batches was written twice."""
    judged = guardrails.verdict(found(spark, d), None, F.col("text"), F.col("entities"))
    log = guardrails.violations_to_log(judged, ["doc_id"]).withColumn("timestamp", F.timestamp_seconds(F.abs("doc_id") * 60))
    log = cut(log)  # the texts are judged once, not once per batch
    path = f"{shared_dir(spark)}/violations-{uuid.uuid4().hex}"
    for batch_id in (0, 1, 0):
        guardrails.append_violations(log.filter(F.pmod("doc_id", F.lit(2)) == batch_id), path, batch_id=batch_id)
    return spark.read.parquet(path).select("doc_id", "position", "rule_name", "severity", "action", "details")


@query("s6")
def _(spark, d):
    """The rule catalogue, and how often the given texts break each rule."""
    judged = guardrails.verdict(found(spark, d), None, F.col("text"), F.col("entities"))
    broken = guardrails.violations_to_log(judged, ["doc_id"]).groupBy(F.col("rule_name").alias("name")).agg(
        F.count("*").alias("violations")
    )
    return guardrails.rules_df(spark).join(broken, "name", "left").fillna(0, ["violations"])


@query("s7")
def _(spark, d):
    used = requests(spark, d).groupBy("provider", "model").agg(F.count("*").alias("requests"))
    return dims.prices_df(spark).join(used, ["provider", "model"], "left").fillna(0, ["requests"])


# ------------------------------------------------------------------ filters and projections
@query("p1")
def _(spark, d):
    return projections.project_recent(requests(spark, d))


@query("p2")
def _(spark, d):
    return projections.in_range(requests(spark, d), at("2024-01-05"), at("2024-01-12 12:00:00")).select(*LOG)


@query("p3")
def _(spark, d):
    return projections.by_user(requests(spark, d), 7, "openai").select(*LOG)


@query("p4")
def _(spark, d):
    t = F.col("request_timestamp")
    return requests(spark, d).select(
        "id",
        dates.to_naive_utc(t, "Europe/Istanbul").alias("from_istanbul"),
        dates.to_naive_utc(t, "America/New_York").alias("from_new_york"),
    )


@query("p5")
def _(spark, d):
    return projections.in_preset(requests(spark, d), at("2024-01-20 15:45:00"), "7d").select(*LOG)


@query("p5_24h")
def _(spark, d):
    return projections.in_preset(requests(spark, d), at("2024-01-20 15:45:00"), "24h").select(*LOG)


@query("p5_30d")
def _(spark, d):
    return projections.in_preset(requests(spark, d), at("2024-02-10 15:45:00"), "30d").select(*LOG)


@query("p6")
def _(spark, d):
    return projections.get_by_id(requests(spark, d), 777).select(*LOG)


def hooks(spark, d):
    """Subscriptions of every nation: three of four active, two of three events each."""
    key = F.col("n_nationkey")
    names = F.array(*[
        F.struct(F.lit(i).alias("k"), F.lit(e).alias("e")) for i, e in enumerate(config.EVENT_NAMES)
    ])
    return derived.table(spark, d, "nation").select(
        key.cast("long").alias("webhook_id"),
        F.concat(F.lit("https://"), F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))), F.lit(".example.org/hook")).alias("url"),
        F.concat(F.lit("secret-"), key.cast("string")).alias("secret"),
        (key % 4 != 3).alias("is_active"),
        F.transform(F.filter(names, lambda n: (key + n["k"]) % 3 != 0), lambda n: n["e"]).alias("events"),
    )


@query("p7")
def _(spark, d):
    return projections.active_hooks(hooks(spark, d), "request.failed").select("webhook_id", "url")


# ------------------------------------------------------------------ joins
@query("j1")
def _(spark, d):
    return requests(spark, d).select("id", "provider", "model", "cost_usd")


@query("j2")
def _(spark, d):
    log = derived.requests(spark, d, cost=False)
    shift = F.make_dt_interval(secs=(F.col("id") % 90).cast("decimal(18,6)"))
    loose = log.filter(F.col("status") == "blocked").select(
        F.col("id").alias("violation_id"), "user_id", (F.col("request_timestamp") - shift).alias("timestamp")
    )
    return attribution.attribute_violations(loose, log)


@query("j3")
def _(spark, d):
    return budgets.budget_status(derived.budgets(spark, d), requests(spark, d), at(ASOF))


@query("j4")
def _(spark, d):
    events = webhooks.derive_events(requests(spark, d))
    return webhooks.fan_out(events.select("event", "event_id"), hooks(spark, d)).select("webhook_id", "event", "event_id")


def entries(spark, d):
    """Embeddings as they arrive, ten seconds apart; each is asked for five seconds before it is stored."""
    start = at("2024-01-01 00:00:00")
    later = lambda s: start + F.make_dt_interval(secs=s.cast("decimal(18,6)"))
    return derived.table(spark, d, "embeddings").select(
        "vec_id", "embedding", later(F.col("vec_id") * 10).alias("created_at"), later(F.col("vec_id") * 10 - 5).alias("asked_at")
    )


def lookup_sides(spark, d):
    e = entries(spark, d)
    return (
        e.select(F.col("vec_id").alias("query_id"), "embedding", "asked_at"),
        e.select(F.col("vec_id").alias("entry_id"), "embedding", "created_at"),
    )


@query("j5")
def _(spark, d):
    return cache.cache_lookup(*lookup_sides(spark, d), threshold=0.35)


def masked(spark, d):
    return masking.mask(found(spark, d), "doc_id")


def stored_masks(spark, d):
    """Masked texts and what is needed to undo them, stored for later."""
    return cut(masked(spark, d).select("doc_id", "text", "session_id", "masked_text", "spans"))


def mapping(df):
    return masking.mask_mapping(df, at("2024-01-01 00:00:00"))


@query("j6")
def _(spark, d):
    m = stored_masks(spark, d)
    return masking.unmask(m.select("doc_id", "session_id", "masked_text"), mapping(m), at("2024-01-01 00:30:00")).select("doc_id", "text")


@query("j7")
def _(spark, d):
    r = derived.requests(spark, d, cost=False)
    i = F.col("id")
    asked = F.when(i % 4 == 0, None).when(i % 4 == 1, "gemini-1.5-pro").otherwise(F.col("model"))
    attempts = r.select(
        "id", F.col("provider").alias("requested_provider"), asked.alias("requested_model"),
        F.explode(F.array(F.lit("openai"), F.lit("gemini"))).alias("provider"),
    ).withColumn(
        "success",
        F.when(F.col("provider") == F.col("requested_provider"), i % 10 != 0).otherwise(i % 100 != 0),
    )
    return routing.resolve_fallback(attempts)


# ------------------------------------------------------------------ reports
@query("a1")
def _(spark, d):
    return analytics.overview(requests(spark, d))


@query("a2")
def _(spark, d):
    return analytics.provider_stats(requests(spark, d))


@query("a3")
def _(spark, d):
    return analytics.user_stats(requests(spark, d))


@query("a4")
def _(spark, d):
    out = None
    for unit in analytics.GRANULARITIES:
        part = analytics.timeline(requests(spark, d), granularity=unit).select(F.lit(unit).alias("granularity"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("a5")
def _(spark, d):
    return analytics.count_requests(requests(spark, d), 3, at("2024-01-05"), None, "openai")


@query("a6")
def _(spark, d):
    return analytics.overview_rates(analytics.overview(requests(spark, d)))


@query("a7")
def _(spark, d):
    return analytics.live(requests(spark, d), at("2024-01-15 12:00:00"))


@query("a8")
def _(spark, d):
    return metrics.requests_total(requests(spark, d))


@query("a9")
def _(spark, d):
    return metrics.errors_total(requests(spark, d))


@query("a10")
def _(spark, d):
    return metrics.cache_hits_total(requests(spark, d))


@query("a11")
def _(spark, d):
    return metrics.pii_total(found(spark, d))


@query("a12")
def _(spark, d):
    judged = guardrails.verdict(found(spark, d), None, F.col("text"), F.col("entities"))
    return metrics.violations_total(guardrails.violations_to_log(judged, ["doc_id"]))


@query("a13")
def _(spark, d):
    return metrics.hist_duration(requests(spark, d))


@query("a14")
def _(spark, d):
    return metrics.hist_tokens(requests(spark, d))


@query("a15")
def _(spark, d):
    return metrics.hist_cost(requests(spark, d))


@query("a16")
def _(spark, d):
    return metrics.concurrency(derived.requests(spark, d, cost=False))


@query("a16_peak")
def _(spark, d):
    return metrics.peak_concurrency(metrics.concurrency(derived.requests(spark, d, cost=False)))


@query("a17")
def _(spark, d):
    return metrics.cache_size(entries(spark, d), at("2024-01-01 01:10:00"))


@query("a18")
def _(spark, d):
    return budgets.budget_usage(budgets.budget_status(derived.budgets(spark, d), requests(spark, d), at(ASOF)))


# ------------------------------------------------------------------ ordered state
@query("w1")
def _(spark, d):
    return limits.trailing_counts(derived.requests(spark, d, cost=False))


def tight(spark):
    """Limits low enough to bind on the given events."""
    return dims.tiers_df(spark, [("default", 1, 1), ("even", 1, 2)])


def tiered(df):
    return df.withColumn("tier", F.when(F.col("user_id") % 2 == 0, "even"))


@query("w2")
def _(spark, d):
    return limits.rate_limit(tiered(derived.requests(spark, d, cost=False)), tight(spark))


@query("w3")
def _(spark, d):
    tier = F.when(F.col("id") % 3 == 0, "premium").when(F.col("id") % 3 == 1, "gold")
    rows = derived.requests(spark, d, cost=False).select("id", tier.alias("tier"))
    return limits.with_tier(rows, dims.tiers_df(spark))


@query("w4")
def _(spark, d):
    return derived.requests(spark, d, cost=False).select(
        "id",
        limits.retry_after("request_timestamp", config.MINUTE_SECONDS).alias("retry_minute"),
        limits.retry_after("request_timestamp", config.HOUR_SECONDS).alias("retry_hour"),
    )


@query("w5")
def _(spark, d):
    return budgets.running_spend(requests(spark, d), derived.budgets(spark, d))


def admitted(spark, d):
    estimated = F.col("prompt_tokens") * F.lit(config.USD_PER_TOKEN)
    return budgets.budget_admission(
        requests(spark, d).withColumn("estimated_usd", estimated), derived.budgets(spark, d)
    )


@query("w6")
def _(spark, d):
    return admitted(spark, d)


@query("w7")
def _(spark, d):
    return budgets.budget_alerts(requests(spark, d), derived.budgets(spark, d))


@query("w8")
def _(spark, d):
    usage = budgets.budget_usage(budgets.budget_status(derived.budgets(spark, d), requests(spark, d), at(ASOF)))
    return usage.select(
        "user_id", budgets.usage_band("usage_ratio").alias("band"), budgets.usage_percent("usage_ratio").alias("percent")
    )


# ------------------------------------------------------------------ top-k and pages
@query("t1")
def _(spark, d):
    return projections.recent(requests(spark, d), 5, 10).select(*LOG)


@query("t1_all_users")
def _(spark, d):
    return projections.recent_per_user(derived.requests(spark, d, cost=False).select("user_id", "id", "request_timestamp"), 3)


@query("t2")
def _(spark, d):
    return projections.project_recent(projections.recent_all(requests(spark, d), 25))


@query("t3")
def _(spark, d):
    return projections.page(requests(spark, d), 5, provider="openai", limit=10, offset=10).select(*LOG)


def usage_rules():
    return [
        guardrails.MaxTokens(2000, name="max_tokens", severity="error", action="block"),
        guardrails.MaxCost(0.05, name="custom_max_cost", severity="error", action="block"),
    ]


def violation_log(spark, d):
    r = requests(spark, d).withColumnRenamed("id", "request_id").withColumnRenamed("request_timestamp", "timestamp")
    judged = guardrails.verdict(r, usage_rules(), tokens=F.col("total_tokens"), cost=F.col("cost_usd"))
    return guardrails.violations_to_log(judged, ["request_id", "user_id", "timestamp"]).drop("details")


@query("t4")
def _(spark, d):
    return projections.recent_violations(violation_log(spark, d))


@query("t5")
def _(spark, d):
    return projections.recent_violations(violation_log(spark, d), None, 50, "custom_max_cost")


@query("t6")
def _(spark, d):
    mine = projections.by_user(derived.requests(spark, d, cost=False), 5)
    return projections.envelope(mine, 2, 20).select("id", "request_timestamp", "total", "page", "page_size", "pages")


# ------------------------------------------------------------------ detection
def _one_type(entity_type: str):
    def run(spark, d):
        return pii.explode_entities(pii.with_entities(texts(spark, d), types=[entity_type]), "doc_id")

    return run


for _n, _t in enumerate(config.REGEX_TYPES, start=1):
    query(f"d{_n}")(_one_type(_t))


@query("d7")
def _(spark, d):
    numbers = documents(spark, d).withColumn("entities", spans.pattern_spans(F.col("text"), r"[0-9]+", "NUMBER"))
    return pii.explode_entities(numbers, "doc_id")


@query("d8")
def _(spark, d):
    return pii.explode_entities(found(spark, d), "doc_id")


@query("d9")
def _(spark, d):
    return derived.table(spark, d, "documents").select(
        "doc_id", pii.guess_lang("text").alias("guess"), pii.guess_lang("text", strict=True).alias("strict_guess")
    )


def ner(spark, d):
    """Tagger spans: one near the start of each document, and one around each pattern span."""
    labels = F.array(*[F.lit(x) for x in ("PERSON", "ORG", "GPE", "LOC", "MONEY", "DATE", "NORP")])
    label = lambda i: F.element_at(labels, (i % 7 + 1).cast("int"))
    start = (F.col("doc_id") % 50).cast("int")
    one = documents(spark, d).select(
        "doc_id", label(F.col("doc_id")).alias("label"), F.substring("text", start + 1, F.lit(8)).alias("entity"),
        start.alias("span_start"), (start + 8).alias("span_end"),
    )
    order = F.array(*[F.lit(t) for t in config.REGEX_TYPES])
    around = document_spans(spark, d).select(
        "doc_id", label(F.array_position(order, F.col("type")) - 1).alias("label"), "entity",
        F.greatest(F.col("span_start") - F.col("doc_id") % 3, F.lit(0)).cast("int").alias("span_start"),
        (F.col("span_end") + F.col("doc_id") % 4).cast("int").alias("span_end"),
    )
    return one.unionByName(around)


def document_spans(spark, d):
    return pii.explode_entities(pii.with_entities(documents(spark, d)), "doc_id")


@query("d10")
def _(spark, d):
    return pii.map_ner(ner(spark, d)).select("doc_id", "label", "type", "entity", "span_start", "span_end", "confidence")


@query("d11")
def _(spark, d):
    return pii.suppress(pii.map_ner(ner(spark, d)), document_spans(spark, d), "doc_id").select(
        "doc_id", "type", "entity", "span_start", "span_end"
    )


@query("d12")
def _(spark, d):
    return pii.explode_entities(pii.detect_detailed(documents(spark, d), ner(spark, d), "doc_id"), "doc_id").drop("confidence")


@query("d13")
def _(spark, d):
    words = spark.createDataFrame(
        [("Is", "ORG"), ("That", "PERSON"), ("Le", "GPE"), ("El", "LOC"), ("Die", "DATE"), ("the", "PERSON")],
        "word string, label string",
    )
    return pii.tag(documents(spark, d), pii.dictionary_tagger(words), "doc_id")


@query("d14")
def _(spark, d):
    return pii.detect_summary(found(spark, d), "doc_id")


# ------------------------------------------------------------------ masking
@query("m1")
def _(spark, d):
    return masked(spark, d).select("doc_id", "session_id", "masked_text", F.size("spans").alias("n_masked"))


@query("m2")
def _(spark, d):
    return mapping(masked(spark, d))


@query("m3")
def _(spark, d):
    m = stored_masks(spark, d)
    kept, way_back = m.select("doc_id", "session_id", "masked_text"), mapping(m)
    live_now = masking.unmask(kept, way_back, at("2024-01-01 00:59:59"), name="restored")
    return masking.unmask(live_now, way_back, at("2024-01-01 01:00:00"), name="after_expiry").select(
        "doc_id", "restored", "after_expiry"
    )


@query("m4")
def _(spark, d):
    return masking.mask_turns(turns(spark, d))


# ------------------------------------------------------------------ guardrails
@query("g1")
def _(spark, d):
    rule = guardrails.MaxTokens(2000, name="max_tokens")
    broken = rule.check(None, None, F.col("total_tokens"), None)
    return requests(spark, d).select("id", broken["message"].alias("message"), broken["details"].alias("details"))


@query("g2")
def _(spark, d):
    rule = guardrails.MaxCost(0.05, name="max_cost")
    return requests(spark, d).select("id", rule.check(None, None, None, F.col("cost_usd"))["message"].alias("message"))


@query("g3")
def _(spark, d):
    rule = guardrails.NoPII(["TCKN", "CREDIT_CARD", "IBAN"], name="no_pii")
    broken = rule.check(None, F.col("entities"), None, None)
    return found(spark, d).select("doc_id", broken["message"].alias("message")).filter("message IS NOT NULL")


@query("g4")
def _(spark, d):
    patterns = config.BUILTIN_RULES[2]["patterns"]
    return documents(spark, d).select("doc_id", guardrails.content_matches(F.col("text"), patterns).alias("matched"))


@query("g4_patterns")
def _(spark, d):
    """Patterns that only stand by themselves: back-references, a lazy and a possessive start."""
    t = F.col("text")
    return documents(spark, d).select(
        "doc_id",
        guardrails.content_matches(t, [r"(e)\1", r"(s)\1"]).alias("doubled"),
        guardrails.content_matches(t, [".*?that.*"]).alias("lazy"),
        guardrails.content_matches(t, [".*+that", "whst"]).alias("possessive"),
    )


@query("g5")
def _(spark, d):
    judged = guardrails.verdict(found(spark, d), None, F.col("text"), F.col("entities"))
    return judged.select(
        "doc_id", F.size("violations").alias("n_violations"), "passed", "should_block",
        F.array_join(F.transform("violations", lambda v: v["rule_name"]), ",").alias("broken_rules"),
    )


@query("g6")
def _(spark, d):
    test = lambda op: guardrails.compare(F.col("duration_ms"), F.lit(1000), op)
    return requests(spark, d).select(
        "id", *[test(op).alias(op) for op in ("gt", "gte", "lt", "lte", "eq")], test("ne").alias("unknown")
    )


@query("g7")
def _(spark, d):
    return found(spark, d).select(
        "doc_id",
        guardrails.pii_at_least(F.col("entities"), ["PHONE", "EMAIL"], 2).alias("two_contacts"),
        guardrails.pii_at_least(F.col("entities"), None, 1).alias("any_entity"),
    )


@query("g8")
def _(spark, d):
    t = texts(spark, d)
    pairs = t.withColumnRenamed("text", "prompt").join(
        t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("completion")), "doc_id", "left"
    )
    return guardrails.two_pass(pairs).select(
        "doc_id", F.size("in_violations").alias("in_violations"), F.size("out_violations").alias("out_violations"), "blocked"
    )


@query("g8_turns")
def _(spark, d):
    pairs = guardrails.turn_pairs(turns(spark, d))
    return guardrails.two_pass(pairs).select(
        "conv_id", "turn", F.size("in_violations").alias("in_violations"), F.size("out_violations").alias("out_violations"), "blocked"
    )


class LongText(guardrails.Rule):
    """A custom rule: texts over 2000 characters."""

    def check(self, text, entities, tokens, cost):
        message = F.concat(F.lit("Text of "), F.length(text).cast("string"), F.lit(" characters"))
        return self.violation(F.length(text) > 2000, message)


@query("g9")
def _(spark, d):
    judged = guardrails.verdict(documents(spark, d), [LongText("long_text")], F.col("text"))
    return judged.select("doc_id", F.try_element_at("violations", F.lit(1))["message"].alias("message"))


# ------------------------------------------------------------------ cache
def neighbours(spark, d):
    e = entries(spark, d)
    return e.select("vec_id", F.col("embedding").alias("a")).join(
        e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id"
    )


@query("c1")
def _(spark, d):
    return neighbours(spark, d).select("vec_id", vectors.cosine("a", "b").alias("cosine"))


@query("c2")
def _(spark, d):
    return neighbours(spark, d).select("vec_id", vectors.is_similar("a", "b", 0.1).alias("similar"))


@query("c3")
def _(spark, d):
    turn_id = F.col("conv_id") * 1000 + F.col("turn")
    rows = derived.table(spark, d, "conversations").select(
        "text", turn_id.alias("response"),
        (at("2024-01-01 00:00:00") + F.make_dt_interval(secs=turn_id.cast("decimal(18,6)"))).alias("created_at"),
    )
    return cache.cache_put(rows)


@query("c4")
def _(spark, d):
    return cache.live_entries(entries(spark, d), at("2024-01-01 01:10:00")).select(F.col("vec_id").alias("entry_id"), "created_at")


@query("c5")
def _(spark, d):
    return cache.cache_lookup_lsh(*lookup_sides(spark, d), dim=64, threshold=0.35, bits=4, recall=0.95)


@query("c6")
def _(spark, d):
    hits = cache.cache_lookup(*lookup_sides(spark, d), threshold=0.4)
    return cache.apply_cache(requests(spark, d), hits).select("id", "cache_hit", "cached_from", "cost_usd", "needs_budget")


@query("c7")
def _(spark, d):
    vec = cache.embed(documents(spark, d))
    return vec.select("doc_id", F.size("embedding").alias("dim"), F.round(vectors.norm("embedding"), 5).alias("length"))


# ------------------------------------------------------------------ routing and chat
@query("r1")
def _(spark, d):
    return documents(spark, d).select(
        "doc_id", costs.word_count("text").alias("words"), costs.estimate_cost("text").alias("estimated_usd")
    )


@query("r2")
def _(spark, d):
    return routing.count_chat_tokens(derived.table(spark, d, "conversations"))


@query("r3")
def _(spark, d):
    return routing.ab_assign(requests(spark, d).select("id"), "id")


@query("r4")
def _(spark, d):
    return routing.ab_report(routing.ab_assign(requests(spark, d), "id"))


@query("r5")
def _(spark, d):
    i = F.col("id")
    rows = derived.requests(spark, d, cost=False).select(
        "id", F.when(i % 4 != 0, F.col("provider")).alias("provider"), F.when(i % 3 != 0, F.col("model")).alias("model")
    )
    return routing.with_defaults(rows)


@query("r6")
def _(spark, d):
    return routing.normalise_roles(derived.table(spark, d, "conversations"))


@query("r7")
def _(spark, d):
    return projections.split_tokens(analytics.timeline(requests(spark, d), granularity="day"))


# ------------------------------------------------------------------ dates and texts
@query("f1")
def _(spark, d):
    t = F.col("request_timestamp")
    rows = derived.requests(spark, d, cost=False).select(
        "id", t, F.explode(F.array(F.lit("daily"), F.lit("weekly"), F.lit("monthly"))).alias("period")
    )
    return rows.select(
        "id", "period", dates.period_start(t, F.col("period")).alias("period_start"),
        dates.period_end(t, F.col("period")).alias("period_end"),
    )


@query("f2")
def _(spark, d):
    t = F.col("request_timestamp")
    return derived.requests(spark, d, cost=False).select(
        "id", *[dates.next_reset(t, F.lit(p)).alias(f"{p}_reset") for p in ("daily", "weekly", "monthly")]
    )


@query("f3")
def _(spark, d):
    ms = F.col("duration_ms").cast("long") * (1 + F.col("id") % 40)
    return requests(spark, d).select("id", formats.fmt_duration(ms).alias("duration_text"))


@query("f4")
def _(spark, d):
    return requests(spark, d).select("id", formats.fmt_cost(F.col("cost_usd") * (1 + F.col("id") % 30)).alias("cost_text"))


@query("f5")
def _(spark, d):
    n = F.col("total_tokens").cast("long") * (1 + F.col("id") % 1500)
    return requests(spark, d).select("id", formats.fmt_tokens(n).alias("token_text"))


# ------------------------------------------------------------------ events
@query("h1")
def _(spark, d):
    return webhooks.derive_events(requests(spark, d), violation_log(spark, d), admitted(spark, d))


@query("h2")
def _(spark, d):
    return webhooks.payload(webhooks.derive_events(requests(spark, d))).select("event_id", "event", "payload")


@query("h3")
def _(spark, d):
    return webhooks.outbox(webhooks.derive_events(requests(spark, d)), hooks(spark, d)).select("webhook_id", "event_id", "signature")


@query("h4")
def _(spark, d):
    return webhooks.outbox(webhooks.derive_events(requests(spark, d)), hooks(spark, d))


@query("h5")
def _(spark, d):
    deliveries = webhooks.fan_out(
        webhooks.derive_events(requests(spark, d)).select("event", "event_id", "timestamp"), hooks(spark, d)
    )
    return webhooks.retry_plan(deliveries).select("webhook_id", "event", "event_id", "attempt", "due_at")


# ------------------------------------------------------------------ whole jobs and streams
@query("x1")
def _(spark, d):
    return screening.screening_report(texts(spark, d), "doc_id")


@query("x2")
def _(spark, d):
    docs = derived.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    # The completion is the text of the next document; to every eleventh a card number is added.
    card = F.when(F.col("id") % 11 == 0, " Card 4111-1111-1111-1111.").otherwise("")
    replies = docs.select((F.col("id") - 1).alias("id"), F.col("text").alias("reply"))
    rows = tiered(requests(spark, d)).join(docs, "id", "left").join(replies, "id", "left")
    rows = rows.withColumn("completion", F.concat("reply", card)).drop("reply")
    # Every request asks with one of the first 500 vectors; the cache also receives the given entries.
    vectors = entries(spark, d).select(F.col("vec_id").alias("vec"), "embedding")
    rows = rows.withColumn("vec", F.col("id") % 500).join(vectors, "vec", "left").drop("vec")
    _, stored = lookup_sides(spark, d)
    return replay_plan.replay(
        rows, tight(spark), derived.budgets(spark, d), stored, threshold=0.35, ttl=86_400
    )


def stream_events(spark, d, build, mode: str, slices: int = 4) -> DataFrame:
    """Rows of ``build(requests)`` over the event table as it arrives: slices in order of time, one micro-batch each.

    A slice may be many files, and their order says nothing on the time of their rows. So the query is started once for each
    slice, from its checkpoint, and takes all that is new as one micro-batch.
    """
    events = derived.table(spark, d, "events")
    base = f"{shared_dir(spark)}/arriving-{uuid.uuid4().hex}"
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    edges = events.agg(F.percentile_approx(us, [i / slices for i in range(1, slices)]).alias("e")).first()["e"] or []
    for low, high in zip([None, *edges], [*edges, None]):
        part = events if low is None else events.filter(us > low)
        (part if high is None else part.filter(us <= high)).write.mode("append").parquet(f"{base}/in")
        stream = derived.as_requests(spark.readStream.schema(events.schema).parquet(f"{base}/in"))
        rows = run_stream(spark, build(stream), mode, base)
    return rows


def run_stream(spark, stream: DataFrame, mode: str, base: str | None = None) -> DataFrame:
    """Run a stream over what is there and return its rows, with the batch each came from.

    With the folder of an earlier run it goes on from that run's checkpoint.
    """
    base = base or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    (
        stream.writeStream.outputMode(mode)
        .foreachBatch(lambda df, batch: queue.write_batch(df, f"{base}/rows", batch))
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.parquet(f"{base}/rows")


@query("x3")
def _(spark, d):
    rows = stream_events(spark, d, lambda s: live.live_stats(costs.with_cost(s, dims.prices_df(spark))), "update")
    keys = ["window_start", "window_end"]
    latest = F.max_by(F.struct(*[c for c in rows.columns if c not in (*keys, "batch_id")]), "batch_id")
    return rows.groupBy(*keys).agg(latest.alias("v")).select(*keys, "v.*")


@query("x3_sliding")
def _(spark, d):
    priced = lambda s: costs.with_cost(s, dims.prices_df(spark))
    rows = stream_events(spark, d, lambda s: live.live_stats(priced(s), slide="20 minutes"), "update")
    latest = F.max_by(F.struct("total_requests", "total_tokens"), "batch_id").alias("v")
    return rows.groupBy("window_start", "window_end").agg(latest).select("window_start", "window_end", "v.*")


@query("x4")
def _(spark, d):
    rows = stream_events(spark, d, lambda s: limiter.limit_stream(tiered(s), tight(spark)), "append")
    return limiter.decisions(rows).select("user_id", "id", "allowed", "limited_by")


@query("x4_late")
def _(spark, d):
    """Every seventh event arrives after all others; the query is started again for them, from its checkpoint."""
    events, base = derived.table(spark, d, "events"), f"{shared_dir(spark)}/late-{uuid.uuid4().hex}"
    seventh = F.col("event_id") % 7 == 0
    for part in (~seventh, seventh):
        events.filter(part).write.mode("append").parquet(f"{base}/in")
        stream = derived.as_requests(spark.readStream.schema(events.schema).parquet(f"{base}/in"))
        rows = run_stream(spark, limiter.limit_stream(tiered(stream), tight(spark)), "append", base)
    return limiter.late_requests(rows).select("user_id", "id")


@query("x5")
def _(spark, d):
    base = f"{shared_dir(spark)}/screened-{uuid.uuid4().hex}"
    rows = texts(spark, d).select(
        F.col("doc_id").cast("string").alias("id"), F.lit("u").alias("user_id"),
        F.lit("2024-01-01T00:00:00").alias("request_timestamp"), "text",
    )
    stream = queue.read_queue(spark, _messages(spark, d, rows))
    queue.consume(
        stream, queue.screening_handler(f"{base}/screened", f"{base}/violations"), f"{base}/bad", f"{base}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{base}/screened").select("id", "passed", "should_block", "masked_text")


@query("x6")
def _(spark, d):
    m = stored_masks(spark, d)
    n = F.ceil(F.length("masked_text") / 7).cast("int")
    named = m.filter(F.col("session_id") != "")
    chunks = named.select("session_id", "masked_text", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no")).select(
        "session_id", "chunk_no", F.substring("masked_text", F.col("chunk_no") * 7 + 1, F.lit(7)).alias("chunk")
    )
    whole = masking.unmask(masking.join_chunks(chunks), mapping(m))
    rebuilt = named.select("doc_id", "session_id").join(whole.select("session_id", "text"), "session_id", "left")
    return rebuilt.select("doc_id", "text").unionByName(m.filter(F.col("session_id") == "").select("doc_id", "text"))
