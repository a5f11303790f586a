"""Expressions and distributed helpers that several operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.lineage import stored

#: A word is a run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    # the driver serves this file to executors as long as the application runs
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='package-')}/{root.name}", "zip", root.parent, root.name)
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def whole_text(text: str = "text") -> Column:
    """The text, or an empty one for null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to differ from all columns."""
    held = {c.casefold() for c in df.columns}
    out = []
    for name in names:
        while name.casefold() in held:
            name += "_"
        out.append(name)
    return out


def text_key(text: str = "text") -> Column:
    """16 bytes that name a text; null counts as empty."""
    return F.unhex(F.md5(whole_text(text)))


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


#: Slots of a key filter: its size in bytes.
_FILTER_SLOTS = 2**20
_CHUNK_SLOTS = 4096


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(_FILTER_SLOTS))


def may_contain(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A condition that holds for all keys in ``keys``, and for few others while they are few.

    The keys set slots in a filter of fixed size (1 MiB), which reaches the tasks as a
    scalar, so a join that follows needs to shuffle only rows that may match.
    """
    slots = keys.select(_slot(F.col(key)).alias("slot"))
    chunk, at = F.floor(F.col("slot") / _CHUNK_SLOTS).cast("int"), F.col("slot") % _CHUNK_SLOTS
    chunks = slots.groupBy(chunk.alias("chunk")).agg(F.bitmap_construct_agg(at * 8).alias("set"))
    held = F.map_from_entries(F.collect_list(F.struct("chunk", "set")))
    none = F.unhex(F.repeat(F.lit("00"), _CHUNK_SLOTS))
    dense = F.transform(F.sequence(F.lit(0), F.lit(_FILTER_SLOTS // _CHUNK_SLOTS - 1)), lambda i: F.coalesce(F.element_at("held", i), none))
    bits = chunks.agg(held.alias("held")).select(dense.alias("filter")).scalar()

    def test(column: Column) -> Column:
        slot = _slot(column)
        part = F.element_at(bits, (F.floor(slot / _CHUNK_SLOTS) + 1).cast("int"))
        return F.substr(part, (slot % _CHUNK_SLOTS + 1).cast("int"), F.lit(1)) == F.lit(bytearray(b"\x01"))

    return test


def prefix_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], weight: str, out: str, name: str
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows of the group before this one.

    Rows are range-partitioned by group and order and stored with the number of their
    range, so later passes see the same ranges whatever task reruns. One sum per range
    gives the offset of each range; a window inside the range does the rest. A hot
    group just spans many ranges. ``group`` columns must not be null; rows that tie
    in ``order`` get places in an unspecified but stored order.
    """
    keyed = df.select("*", F.struct(*order).alias("_place"), F.monotonically_increasing_id().alias("_row"))
    by = [F.col(g) for g in group] + [F.col("_place"), F.col("_row")]
    ranged = stored(keyed.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()), name)
    cells = [*group, "_range"]
    sums = ranged.groupBy(*cells).agg(F.sum(weight).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*cells, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*cells).orderBy("_place", "_row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return ranged.join(offsets, cells).select(*df.columns, before.alias(out))
