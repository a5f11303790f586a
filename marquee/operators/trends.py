"""Row-based trends over a daily series.

The windows run over one row per calendar day. Such a frame is bounded by the
calendar, not by the number of tickets, so ordering it in one task is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_change(daily: DataFrame, value: str, previous: str, change: str, order: str = "sale_date") -> DataFrame:
    """Add the value of the row before and the rounded difference to it."""
    before = F.lag(value).over(Window.orderBy(order))
    return daily.select("*", before.alias(previous)).withColumn(change, F.round(F.col(value) - F.col(previous), 0))


def with_trailing_mean(daily: DataFrame, value: str, out: str, rows: int = 7, order: str = "sale_date") -> DataFrame:
    """Mean of the last ``rows`` rows; null until all of them are present and not null."""
    frame = Window.orderBy(order).rowsBetween(1 - rows, 0)
    full = F.count(value).over(frame) == rows
    return daily.withColumn(out, F.when(full, F.avg(value).over(frame)))
