"""Expensive expressions that several consumers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a one-row lateral view, so that each is computed once per row.

    A plain projection is copied into every filter that the optimizer moves below it: a filter
    on a verdict would run the detection again for each of its uses. Filters do not move below a
    generator.
    """
    kept = [c for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
