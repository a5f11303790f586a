"""K-d tree sharding by bytes.

All documents with one text form a unit, as long as the unit is at most a quarter of a
shard; larger groups are split by a hash of the id. Starting with one node of all units,
every level cuts each node along its widest metadata dimension at the exact weighted
quantile, found by distributed prefix sums, until each node is one shard. A unit that
lies across the cut goes to the right, and the units behind it fill its place, so large
units do not spoil the balance.

Defined cases: a null text counts as empty, null ids and metadata sort first, equal rows
are separate rows of one unit, an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import prefix_sums, text_key, whole_text
from marquee.operators.lineage import stored

#: Largest part of a shard that one unit may fill.
UNIT_SHARE = 0.25


def order_number(value: Column) -> Column:
    """A number that orders texts by their first six bytes."""
    head = F.substring(F.rpad(F.hex(F.encode(value, "UTF-8")), 12, "0"), 1, 12)
    return F.conv(head, 16, 10).cast("double")


def document_dimensions() -> dict[str, Column]:
    return {
        "size": F.log2(F.col("size").cast("double")),
        "source": order_number(F.col("source")),
        "lang": order_number(F.col("lang")),
        "id": F.col("doc_id").cast("double"),
    }


def shard(docs: DataFrame, shards: int, dimensions: Mapping[str, Column] | None = None, name: str = "shard") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; slots are gapless per shard.

    ``dimensions`` are numeric columns over doc_id, source, lang and size.
    """
    dims = dict(dimensions or document_dimensions())
    text = whole_text()
    size = (F.octet_length(text) + 16).cast("long").alias("size")
    raw = docs.select("doc_id", "source", "lang", size, F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), text_key().alias("text_key"))
    columns = [F.coalesce(c, F.lit(0.0)).alias(f"dim_{n}") for n, c in dims.items()]
    rows = stored(raw.select("doc_id", "size", "text_crc32", "text_key", *columns), name)
    axes = [f"dim_{n}" for n in dims]
    unit_rows = _with_parts(rows, shards)
    units = unit_rows.groupBy("text_key", "part").agg(F.sum("size").alias("w"), *[F.min(a).alias(a) for a in axes])
    placed = _split(stored(units.withColumns({"lo": F.lit(0), "k": F.lit(shards)}), name), axes, shards, name)
    named = unit_rows.select("doc_id", "size", "text_crc32", "text_key", "part").join(
        placed.select("text_key", "part", F.col("lo").alias("shard")), ["text_key", "part"]
    )
    order = [F.col("doc_id"), F.col("text_key")]
    out = prefix_sums(named.withColumn("one", F.lit(1).cast("long")), ["shard"], order, "one", "slot", name)
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")


def _with_parts(rows: DataFrame, shards: int) -> DataFrame:
    """Add the part of the text's group that a row belongs to.

    Only groups above a quarter of a shard have parts, so there are at most
    ``shards / UNIT_SHARE`` of them, which is safe to broadcast.
    """
    groups = rows.groupBy("text_key").agg(F.sum("size").alias("w"))
    unit = rows.agg((F.sum("size") / shards * UNIT_SHARE).alias("unit"))
    large = groups.join(F.broadcast(unit), F.col("w") > F.col("unit")).select(
        F.col("text_key").alias("large_key"), F.ceil(F.col("w") / F.col("unit")).cast("int").alias("parts")
    )
    joined = rows.join(F.broadcast(large), F.col("text_key") == F.col("large_key"), "left")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    return joined.withColumn("part", part.cast("int")).drop("parts", "large_key")


def _split(units: DataFrame, axes: list[str], shards: int, name: str) -> DataFrame:
    """Cut nodes in two, level by level; a node is (first shard, number of shards)."""
    node = ["lo", "k"]
    for _ in range(math.ceil(math.log2(max(1, shards)))):
        done = units.filter("k = 1")
        open_units = units.filter("k > 1")
        whole = open_units.agg(*[(F.max(a) - F.min(a)).alias(f"all_{a}") for a in axes])
        stats = open_units.groupBy(*node).agg(F.sum("w").alias("node_w"), *[(F.max(a) - F.min(a)).alias(f"own_{a}") for a in axes])
        width = [F.coalesce(F.try_divide(F.col(f"own_{a}"), F.col(f"all_{a}")), F.lit(0.0)) for a in axes]
        # at most one row per shard
        nodes = stats.join(F.broadcast(whole)).select(
            *node, "node_w", F.array_position(F.array(*width), F.greatest(*width) if len(width) > 1 else width[0]).alias("axis")
        )
        along = F.element_at(F.array(*axes), F.col("axis").cast("int"))
        ordered = open_units.join(F.broadcast(nodes), node).withColumn("value", along)
        summed = prefix_sums(ordered, node, [F.col("value"), F.col("text_key"), F.col("part")], "w", "before", name)
        left_k = F.floor(F.col("k") / 2)
        cut = F.col("node_w") * left_k / F.col("k")
        summed = summed.withColumns({"left_k": left_k.cast("int"), "cut": cut})
        across = (F.col("before") < F.col("cut")) & (F.col("before") + F.col("w") > F.col("cut"))
        crossing = summed.filter(across).select(*node, F.col("before").alias("cross_at"), F.col("w").alias("cross_w"))
        merged = summed.join(F.broadcast(crossing), node, "left")
        moved = F.col("before") - F.when(F.col("before") > F.col("cross_at"), F.col("cross_w")).otherwise(0)
        left = F.when(F.col("before") == F.col("cross_at"), False).otherwise(moved + F.col("w") / 2 <= F.col("cut"))
        cols = ["text_key", "part", "w", *axes]
        halves = merged.select(
            *cols,
            F.when(left, F.col("lo")).otherwise(F.col("lo") + F.col("left_k")).cast("int").alias("lo"),
            F.when(left, F.col("left_k")).otherwise(F.col("k") - F.col("left_k")).cast("int").alias("k"),
        )
        units = stored(done.select(*cols, *node).unionByName(halves), name)
    return units
