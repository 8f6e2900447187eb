"""Filters, lookups, pages and simple projections over the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import config
from ..functions.dates import preset_range



def project_recent(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "provider",
        "model",
        F.col("total_tokens").alias("tokens"),
        F.col("cost_usd").alias("cost"),
        "duration_ms",
        "cache_hit",
        "pii_detected",
        "status",
        F.col("request_timestamp").alias("timestamp"),
    )


def in_range(df: DataFrame, start=None, end=None, time: str = "request_timestamp", date: str = "request_date") -> DataFrame:
    """Both ends inclusive; an absent bound adds no predicate.

    Where the frame has a date partition column, the bounds are put on it as well, so that the
    scan skips whole days.
    """
    for bound, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if bound is None:
            continue
        value = bound if isinstance(bound, Column) else F.lit(bound).cast("timestamp")
        df = df.filter(keep(F.col(time), value))
        if date in df.columns:
            df = df.filter(keep(F.col(date), F.to_date(value)))
    return df


def in_preset(df: DataFrame, now: Column, preset: str = "7d", time: str = "request_timestamp") -> DataFrame:
    start, end = preset_range(now, preset)
    return in_range(df, start, end, time)


def by_user(df: DataFrame, user=None, provider: str | None = None) -> DataFrame:
    if user is not None:
        df = df.filter(F.col("user_id") == user)
    if provider is not None:
        df = df.filter(F.col("provider") == provider)
    return df


def get_by_id(df: DataFrame, request_id) -> DataFrame:
    return df.filter(F.col("id") == request_id)


def active_hooks(df: DataFrame, event: str) -> DataFrame:
    return df.filter(F.col("is_active") & F.array_contains("events", event))


def newest_first(time: str = "request_timestamp", key: str = "id") -> list[Column]:
    return [F.col(time).desc(), F.col(key)]


def recent(df: DataFrame, user, n: int = 10) -> DataFrame:
    """The newest requests of one user: a top-k, never a full sort."""
    return by_user(df, user).orderBy(*newest_first()).limit(n)


def recent_per_user(df: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` of every user; each task keeps only ``n`` rows per user before the shuffle."""
    w = W.partitionBy("user_id").orderBy(*newest_first())
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def recent_all(df: DataFrame, n: int = 10) -> DataFrame:
    return df.orderBy(*newest_first()).limit(n)


def page(
    df: DataFrame, user=None, start=None, end=None, provider: str | None = None,
    limit: int = 100, offset: int = 0,
) -> DataFrame:
    rows = in_range(by_user(df, user, provider), start, end)
    return rows.orderBy(*newest_first()).limit(offset + limit).offset(offset)


def recent_violations(log: DataFrame, user=None, n: int = 100, rule: str | None = None) -> DataFrame:
    """The newest violations, of one user and one rule if given."""
    rows = by_user(log, user)
    if rule is not None:
        rows = rows.filter(F.col("rule_name") == rule)
    return rows.orderBy(F.col("timestamp").desc(), "request_id", "position").limit(n)



def envelope(df: DataFrame, page_no: int = 1, page_size: int = 20) -> DataFrame:
    """Items of one page, each row with the envelope values. The total is a scalar subquery."""
    items = df.orderBy(*newest_first()).limit(page_no * page_size).offset((page_no - 1) * page_size)
    total = df.agg(F.count("*").alias("total")).scalar()
    return items.withColumn("total", total).select(
        "*",
        F.lit(page_no).alias("page"),
        F.lit(page_size).alias("page_size"),
        F.ceil(F.col("total") / page_size).cast("long").alias("pages"),
    )


def split_tokens(timeline: DataFrame) -> DataFrame:
    """Estimated prompt and completion shares where only totals are known."""
    return timeline.select(
        "time_bucket",
        (F.col("total_tokens") * config.PROMPT_SHARE).alias("prompt"),
        (F.col("total_tokens") * config.COMPLETION_SHARE).alias("completion"),
        F.col("total_tokens").alias("total"),
    )
