"""Exact money arithmetic: amounts are carried as integer minor units inside
window sums so that prior-sums subtract exactly (no float prefix drift)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_minor(amount, scale: int = 2) -> Column:
    a = F.col(amount) if isinstance(amount, str) else amount
    return F.round(a * F.lit(10 ** scale)).cast("long")
