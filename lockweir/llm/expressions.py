"""Helpers for nested column expressions."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where ``use`` needs it within a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
