"""Row-level operators: de-duplication, top-k, label alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def keep_one(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key: the smallest by the remaining columns, nulls first.

    A minimum combines inside each task before the shuffle, so many copies of one
    key cost no more than one; a ranking window would sort them all in one task.
    Texts make it an aggregate that sorts the rows of a task, so rows are dealt over tasks of a
    set size first, whatever the files are; dealt by all columns, a hot key is spread as before.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.hint("rebalance", *[f"`{c}`" for c in df.columns]).groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.`{c}`").alias(c) for c in df.columns])


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First k rows of an order that must end in a unique key."""
    return df.orderBy(*order).limit(k)


def measures_as_rows(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """The numbers of a report as rows (report, item, measure, value); ``item`` joins the keys, null as an empty text."""
    numbers = [f.name for f in df.schema if f.name not in keys and f.dataType.typeName() not in ("string", "date", "boolean")]
    item = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    wide = df.select(item.alias("item"), *[F.col(c).cast("double").alias(c) for c in numbers])
    return wide.unpivot("item", numbers, "measure", "value").select(F.lit(name).alias("report"), "item", "measure", "value")


def label_frame(spark: SparkSession, column: str, labels: Sequence[str]) -> DataFrame:
    """Labels with their position, in columns ``column`` and ``position``."""
    entries = [F.struct(F.lit(i).alias("position"), F.lit(v).alias(column)) for i, v in enumerate(labels)]
    return spark.range(1).select(F.inline(F.array(*entries)))


def align(df: DataFrame, column: str, labels: Sequence[str], fill: int | None = None) -> DataFrame:
    """Exactly one row per label in label order; absent ones are null, or ``fill``."""
    values = [c for c in df.columns if c != column]
    frame = label_frame(df.sparkSession, column, labels)
    aligned = frame.join(df, column, "left").orderBy("position").select(column, *values)
    return aligned if fill is None else aligned.na.fill(fill, subset=values)
