"""Profiles and checks, returned as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marquee.functions.columns import is_missing
from marquee.operators.lineage import stored


def profile(df: DataFrame, name: str) -> DataFrame:
    """Null or empty cells per column, in one pass: table, column_name, rows, null_or_empty, flagged."""
    kinds = dict(df.dtypes)
    counts = [F.count(F.when(is_missing(f"`{c}`", kinds[c]), 1)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    one = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_or_empty")) for i, c in enumerate(df.columns)]
    return one.select(F.lit(name).alias("table_name"), "rows", F.inline(F.array(*entries))).select(
        "table_name", "column_name", "rows", "null_or_empty", (F.col("null_or_empty") > 0).alias("flagged")
    )


def shape(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row and column counts of several frames: table_name, rows, columns."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in frames.items()
    ]
    return _stack(parts)


def frequencies(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Value counts, most frequent first, or in value order."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(column) if by_value else counted.orderBy(F.desc("count"), column)


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values per column, a null counting as one value: column_name, distinct_values.

    One pass; copies of a value are merged inside each task before the shuffle.
    """
    seen = _long(df, columns).distinct()
    return seen.groupBy(F.col("check").alias("column_name")).agg(F.count(F.lit(1)).alias("distinct_values"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def not_positive(df: DataFrame, *columns: str) -> DataFrame:
    """Values of zero or less per column, in one row."""
    return df.agg(*[F.count_if(F.col(c) <= 0).alias(f"invalid_{c}") for c in columns])


#: The columns that the checks of the fact look at.
CHECKED = ("film_name", "customer_id", "sale_date", "slot_type", "show_session", "ticket_price", "total")


def fact_checks(fact: DataFrame, account: Observation | None = None) -> DataFrame:
    """All checks of the fact as rows of (check, item, value), in one pass over the fact.

    Date range, bad amounts and the ``account`` of cleaning are observed while four columns are stored;
    frequencies and distinct counts then read one or two stored columns each.
    """
    invalid = ("ticket_price", "total")
    seen = Observation()
    observed = fact.observe(
        seen, F.min("sale_date").alias("min"), F.max("sale_date").alias("max"),
        *[F.count_if(F.col(c) <= 0).alias(c) for c in invalid],
    )
    kept = stored(observed.select("slot_type", "show_session", "film_name", "customer_id"), "checks")
    facts = seen.get
    scalars = [("date_range", c, facts[c]) for c in ("min", "max")] + [("not_positive", c, facts[c]) for c in invalid]
    if account is not None:
        scalars += [("account", item, value) for item, value in account.get.items()]
    rows = [(check, item, None if value is None else str(value)) for check, item, value in scalars]
    told = fact.sparkSession.createDataFrame(rows, "check string, item string, value string")
    pairs = kept.groupBy("slot_type", "show_session").agg(F.count(F.lit(1)).alias("value"))
    values = _long(pairs, ("slot_type", "show_session"), "value").groupBy("check", "item").agg(F.sum("value").cast("string").alias("value"))
    distinct = [
        kept.select(c).distinct().agg(F.count(F.lit(1)).cast("string").alias("value")).select(F.lit("distinct").alias("check"), F.lit(c).alias("item"), "value")
        for c in ("film_name", "customer_id")
    ]
    return _stack([told, values, *distinct])


def customer_checks(customers: DataFrame) -> DataFrame:
    """Distributions of the customer dimension as rows of (check, item, value)."""
    counted = _value_counts(customers, "gender", "age_group", "customer_type")
    return counted.withColumn("value", F.col("value").cast("string"))


def _value_counts(df: DataFrame, *columns: str) -> DataFrame:
    return _long(df, columns).groupBy("check", "item").agg(F.count(F.lit(1)).alias("value"))


def _long(df: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    """One (check, item) row per column of each row, beside ``more`` columns."""
    entries = [F.struct(F.lit(c).alias("check"), F.col(c).cast("string").alias("item")) for c in columns]
    return df.select(F.inline(F.array(*entries)), *more)


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
