"""Pricing of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config


def with_cost(df: DataFrame, prices: DataFrame, name: str = "cost_usd") -> DataFrame:
    """Add the cost of each request; an unknown model costs nothing.

    A price list from ``dims`` is broadcast, so the join does not shuffle the log.
    """
    joined = df.join(prices, ["provider", "model"], "left")
    cost = F.col("prompt_tokens") / 1000.0 * F.coalesce("prompt_price", F.lit(0.0)) + F.col(
        "completion_tokens"
    ) / 1000.0 * F.coalesce("completion_price", F.lit(0.0))
    return joined.select(*df.columns, cost.alias(name))


def word_count(text: Column | str) -> Column:
    """Words separated by whitespace; leading and trailing blanks make none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f]+")), F.lit(0))


def estimate_cost(text: Column | str) -> Column:
    """Rough cost of a prompt before it is sent."""
    return word_count(text) * F.lit(config.TOKENS_PER_WORD) * F.lit(config.USD_PER_TOKEN)
