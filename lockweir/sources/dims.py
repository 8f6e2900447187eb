"""Small dimensions that come from configuration: prices, variants, tiers, models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config


BROADCAST_BYTES = 8 << 20


def listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A dimension from a list on the driver.

    Its size is known here, so this is where the broadcast hint is given; a larger list, or a
    table passed in its place, is joined by whatever strategy its size calls for.
    """
    df = spark.createDataFrame(rows, schema)
    size = sum(len(str(value)) + 16 for row in rows for value in row)
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def prices_df(spark: SparkSession, prices=config.PRICES) -> DataFrame:
    return listed(
        spark, list(prices), "provider string, model string, prompt_price double, completion_price double"
    )


def tiers_df(spark: SparkSession, tiers=config.TIERS) -> DataFrame:
    return listed(spark, list(tiers), "tier string, per_minute int, per_hour int")


def models_df(spark: SparkSession, prices=config.PRICES) -> DataFrame:
    """Which provider owns which model."""
    return prices_df(spark, prices).select("provider", "model")


def default_models_df(spark: SparkSession, defaults=config.DEFAULT_MODELS) -> DataFrame:
    return listed(spark, list(defaults.items()), "provider string, default_model string")
