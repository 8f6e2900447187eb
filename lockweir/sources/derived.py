"""Request-shaped views over the given event, order, document and embedding tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.costs import with_cost
from .dims import prices_df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def requests(spark: SparkSession, sf_dir: str, cost: bool = True) -> DataFrame:
    """The event table read as a request log."""
    df = as_requests(table(spark, sf_dir, "events"))
    return with_cost(df, prices_df(spark)) if cost else df


def as_requests(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    model = (
        F.when(e % 9 == 0, "gemini-1.5-pro").when(e % 9 == 3, "gemini-1.5-flash")
        .when(e % 9 == 6, "gemini-2.5-flash-lite").when(e % 9 == 1, "gpt-4")
        .when(e % 9 == 2, "gpt-4-turbo-preview").when(e % 9 == 4, "gpt-3.5-turbo")
        .when(e % 9 == 5, "unpriced-model").otherwise("gpt-4o-mini")
    )
    status = (
        F.when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "blocked")
        .otherwise("completed")
    )
    return events.select(
        e.alias("id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("request_timestamp"),
        F.when(e % 3 == 0, "gemini").otherwise("openai").alias("provider"),
        model.alias("model"),
        (20 + 13 * F.regexp_extract("props", "([0-9]+)", 1).cast("int")).alias("prompt_tokens"),
        F.floor(F.col("value") * 10).cast("int").alias("completion_tokens"),
        (50 + F.floor(F.col("value") * 20).cast("int")).alias("duration_ms"),
        (e % 5 == 0).alias("cache_hit"),
        (e % 7 == 0).alias("pii_detected"),
        status.alias("status"),
    ).withColumn("total_tokens", F.col("prompt_tokens") + F.col("completion_tokens"))



def probe_texts(orders: DataFrame) -> DataFrame:
    """One text per order that holds a national id, an IBAN and an amount."""
    digits = lambda *powers: sum(((F.col("b") / F.lit(10**p)).cast("long") % 10 for p in powers), F.lit(0))
    k = F.col("o_orderkey")
    base = (
        orders.select(k, "o_totalprice", (100000000 + (k * 7919) % 900000000).alias("b"))
        .withColumn("od", digits(8, 6, 4, 2, 0))
        .withColumn("ev", digits(7, 5, 3, 1))
        .withColumn("d10", (7 * F.col("od") - F.col("ev") + 70) % 10)
    )
    d11 = (F.col("od") + F.col("ev") + F.col("d10") + F.when(k % 3 == 0, 1).otherwise(0)) % 10
    return base.select(
        k.alias("doc_id"),
        F.concat(
            F.lit("id "), F.col("b").cast("string"), F.col("d10").cast("string"), d11.cast("string"),
            F.lit(" iban TR"),
            F.lpad((98 - (k * 1000000 + 292700) % 97).cast("string"), 2, "0"),
            F.lpad(k.cast("string"), 22, "0"),
            F.lit(" paid "),
            F.col("o_totalprice").cast("decimal(12,2)").cast("string"),
            F.lit(" TRY"),
        ).alias("text"),
    )


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One budget per user that ever sent a request; users divisible by 7 have none."""
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events").select("user_id").distinct().filter(user % 7 != 0)
        .select(
            user,
            (0.5 + 0.1 * (user % 5)).alias("limit_usd"),
            F.when(user % 3 == 0, "daily").when(user % 3 == 1, "weekly").otherwise("monthly").alias("period"),
        )
    )
