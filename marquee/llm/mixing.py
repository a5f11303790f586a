"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source the keys are cut into ranges by
their leading digits; one sum of words per range, added up over the ranges, tells in
which range the source's budget ends, and only that range is put in order to find the
exact key at which to cut. Whole epochs come on top. What leaves this step is one row
per source, so no text is shuffled.

Defined cases: null or empty texts have no words and are never taken; a null source is a
source of its own, last in order; rows equal in id and text share one key, and if the
cut falls on them they share what is left of the budget.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import whole_text, word_count
from marquee.operators.lineage import stored

#: Leading hex digits of a key that make up its range: 4,096 ranges per source.
RANGE_DIGITS = 3


def mix_key(key: str = "doc_id", text: str = "text", seed: str = "mix") -> Column:
    """A random-looking text that depends on id and text alone."""
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(seed), name, F.md5(whole_text(text))))


def source_targets(
    sized: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most_epochs: int = 2
) -> DataFrame:
    """Words wanted from each source.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` times all words. No target exceeds ``most_epochs`` times its source; what
    is cut off goes to the others by weight. With sources in the order of
    limit / weight, those before some place are at their limit and the others get
    ``level`` times their weight, which needs one pass. One row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    sources = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", pick).withColumn("limit", F.col("source_size") * most_epochs)
        .withColumn("all_size", F.sum("source_size").over(Window.partitionBy()))
    )
    ratio = F.col("limit") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    spent = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    steps = sources.withColumn("level", (F.col("all_size") * F.lit(float(share)) - spent) / rest)
    free = F.when(F.col("level") < ratio, F.struct(ratio, F.col("source").isNull(), "source", "level"))
    level = F.min(free).over(Window.partitionBy())["level"]
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("weight") * level, F.col("limit").cast("double")))
    return steps.select("source", "source_size", target.alias("target"))


def mix_cuts(sized: DataFrame, **targets) -> DataFrame:
    """Where each source's budget ends, from rows of (source, size, key).

    Returns source, source_size, target, epochs, cut_key, cut_words, cut_size: whole
    epochs, then every key below ``cut_key``, then ``cut_words`` of the ``cut_size``
    words of the rows at that key.
    """
    budget = F.floor("target").cast("long")
    sources = source_targets(sized, **targets).select(
        "*", F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0)).cast("long").alias("epochs")
    )
    sources = sources.withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    lead = F.substring("key", 1, RANGE_DIGITS)
    ranges = sized.groupBy("source", lead.alias("lead")).agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    inside = (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))
    s, r = sources.alias("s"), ranges.alias("r")
    cut_range = s.join(r, F.col("s.source").eqNullSafe(F.col("r.source")) & inside).select(
        F.col("s.source").alias("source"), "lead", "before", "rest"
    )
    d, c = sized.alias("d"), cut_range.alias("c")
    rows = d.join(c, F.col("d.source").eqNullSafe(F.col("c.source")) & (F.substring("d.key", 1, RANGE_DIGITS) == F.col("c.lead")))
    keys = rows.groupBy(F.col("d.source").alias("source"), F.col("d.key").alias("key"), "before", "rest").agg(
        F.sum("size").alias("cut_size")
    )
    earlier = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    keys = keys.withColumn("at", F.col("before") + F.coalesce(F.sum("cut_size").over(earlier), F.lit(0)))
    cut = keys.filter((F.col("at") <= F.col("rest")) & (F.col("rest") < F.col("at") + F.col("cut_size"))).select(
        F.col("source").alias("cut_source"), F.col("key").alias("cut_key"), (F.col("rest") - F.col("at")).alias("cut_words"), "cut_size"
    )
    return sources.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source", "rest")


def taken(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add source_size, target and taken to rows that have source, size and key."""
    d, c = docs.alias("d"), cuts.withColumnRenamed("source", "cut_source").alias("c")
    size = F.col("d.size")
    last = (
        F.when(F.col("d.key") < F.col("c.cut_key"), size)
        .when(F.col("d.key") == F.col("c.cut_key"), F.floor(size * F.col("c.cut_words") / F.col("c.cut_size")).cast("long"))
        .otherwise(0)
    )
    return d.join(c, F.col("d.source").eqNullSafe(F.col("c.cut_source"))).select(
        "d.*", "c.source_size", "c.target", (size * F.col("c.epochs") + last).alias("taken")
    )


def mix_words(docs: DataFrame, name: str = "mix", **targets) -> DataFrame:
    """Per document (doc_id, source, size, source_size, target, taken), without texts."""
    sized = stored(docs.select("doc_id", "source", word_count().alias("size"), mix_key().alias("key")), name)
    return taken(sized, mix_cuts(sized, **targets)).drop("key")


def mix_documents(docs: DataFrame, name: str = "mix", **targets) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, with its own columns.

    A document that the budget cuts through is taken whole, so a source exceeds its
    target by less than one document.
    """
    sizes = docs.select("source", word_count().alias("size"), mix_key().alias("key"))
    cuts = mix_cuts(stored(sizes, name), **targets)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "source", word_count().alias("size"), mix_key().alias("key"))
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    picked = taken(rows, cuts).filter("taken > 0")
    return picked.select("doc", F.explode(F.sequence(F.lit(1), times))).select("doc.*")
