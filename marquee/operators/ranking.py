"""Exact n-tiles over a whole table, without ordering it in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_ROWS_PER_BAND = 1_000_000


def with_ntiles(
    df: DataFrame, key: str, tiles: int, scores: Mapping[str, str], rows_per_band: int = _ROWS_PER_BAND
) -> DataFrame:
    """Add ``NTILE(tiles) OVER (ORDER BY value, md5(key), key)`` for each ``{out: value}``.

    Approximate percentiles cut the value range into bands, which keep the order of
    the rows. A value so frequent that it is itself a cut gets its own band, split
    further by the first two hex digits of ``md5(key)``. The cells are counted, their
    running sum gives the rows before each cell, and a row's place within its cell
    does the rest. Bands grow with the row count, so the rows of a task don't.

    ``df`` is read once for the cuts and again per score: pass a stored frame, with
    unique non-null keys. Null values come first.
    """
    bands = df.count() // rows_per_band + 1
    at = [i / bands for i in range(1, bands)] or [0.5]
    found = df.agg(*[F.percentile_approx(value, at, 10_000).alias(out) for out, value in scores.items()]).first()
    digest = F.md5(F.col(key).cast("string"))
    scored = df
    for out, value in scores.items():
        limits = sorted(set(found[out] or [])) if bands > 1 else []
        cell = [_band(F.col(value), limits).alias("band"), _splinter(F.col(value), limits, digest).alias("splinter")]
        inside = Window.partitionBy("band", "splinter").orderBy(value, digest, key)
        place = F.col("before") + F.row_number().over(inside)
        scored = (
            scored.select("*", *cell)
            .join(_offsets(df.select(*cell)), ["band", "splinter"])
            .withColumn(out, _tile(place, F.col("whole"), tiles))
            .drop("band", "splinter", "before", "whole")
        )
    return scored


def _band(value: Column, limits: list) -> Column:
    """2 x the number of limits below the value, plus 1 when it equals a limit; -1 for null, which sorts first."""
    if not limits:
        return F.when(value.isNull(), -1).otherwise(0)
    below = F.size(F.filter(F.array(*map(F.lit, limits)), lambda limit: limit < value))
    return F.when(value.isNull(), -1).otherwise(below * 2 + value.isin(limits).cast("int"))


def _splinter(value: Column, limits: list, digest: Column) -> Column:
    return F.when(value.isNull() | value.isin(limits), F.substring(digest, 1, 2)).otherwise("") if limits else F.lit("")


def _offsets(cells: DataFrame) -> DataFrame:
    order = Window.orderBy("band", "splinter")
    counted = cells.groupBy("band", "splinter").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return counted.select(
        "band", "splinter",
        F.coalesce(running, F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("whole"),
    )


def _tile(place: Column, whole: Column, tiles: int) -> Column:
    """NTILE of a 1-based place: the first ``whole % tiles`` tiles hold one row more."""
    small, longer = F.floor(whole / tiles), whole % tiles
    head = longer * (small + 1)
    in_head = F.floor((place - 1) / (small + 1)) + 1
    in_tail = longer + F.floor(F.try_divide(place - 1 - head, small)) + 1
    return F.when(place <= head, in_head).otherwise(in_tail).cast("int")
