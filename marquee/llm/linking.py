"""Connected groups of similar items, without listing all pairs of a group.

Items that share a bucket are candidates. In the first round each bucket has one hub, the
item that shares most with others, and every member is only compared with the hub. Groups
found so far then need no more comparison inside; in the second round, members outside
the hub's group are compared with the members of other groups in their bucket. All pairs
of a bucket have then been compared or are known to be connected, so the groups are those
of all pairs, while a family of thousands of copies costs about one comparison each.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import may_contain
from marquee.operators.lineage import emptied, stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """(id, root) of every node of edges (a, b); root is the smallest node it can reach.

    Large-star and small-star steps in turn, each stored, until the edges stay the same.
    All steps are joins and minima, so a node with very many neighbours is spread over tasks.
    """
    u, v = F.greatest("a", "b"), F.least("a", "b")
    now = stored(edges.filter("a != b").select(u.alias("u"), v.alias("v")).distinct(), name)
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
            )
        seen = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), name)


def linked(
    members: DataFrame,
    payload: DataFrame,
    may_link: Callable[[Column, Column], Column],
    prepare: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
    name: str,
    sharpen: Callable[[DataFrame], tuple[DataFrame, Callable[[Column, Column], Column]]] | None = None,
) -> DataFrame:
    """(id, root) of items with a link.

    ``members`` has (bucket, id), ``payload`` (id, p). ``may_link`` compares two payloads
    and must hold for every pair that is to be linked. ``prepare`` gets the ids (id) that
    share a bucket, and returns a function that keeps the pairs (a, b) that are linked.
    ``sharpen`` may give a second condition for the items (id) left to the second round:
    rows (id, s) and a comparison of two ``s`` that holds for every pair to be linked.
    """
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(shared, name)
    live = stored(members.filter(may_contain(shared, "bucket")(F.col("bucket"))).join(shared, "bucket"), name)
    mass = live.groupBy("id").agg(F.sum(F.col("n") - 1).alias("mass"))
    known = stored(mass.join(payload, "id"), name)
    confirm = prepare(known.select("id"))
    hubs = live.join(known.select("id", "mass"), "id").groupBy("bucket").agg(F.max(F.struct("mass", "id"))["id"].alias("hub"))
    hubs = stored(hubs, name)
    a, b = F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")
    pairs = live.join(hubs, "bucket").filter("id != hub").select(a, b).distinct()
    p_a = known.select(F.col("id").alias("a"), F.col("p").alias("pa"))
    p_b = known.select(F.col("id").alias("b"), F.col("p").alias("pb"))
    tried = pairs.join(p_a, "a").join(p_b, "b").filter(may_link(F.col("pa"), F.col("pb"))).select("a", "b")
    tried = stored(tried, name)
    links = stored(confirm(tried), name)
    groups = components(links, name)

    root = F.coalesce("root", "id").alias("root")
    labelled = live.join(known.select("id", "p"), "id").join(groups, "id", "left").select("bucket", "id", "p", root)
    hub_root = hubs.join(groups, F.col("hub") == F.col("id"), "left").select("bucket", F.coalesce("root", "hub").alias("hub_root"))
    labelled = labelled.join(hub_root, "bucket")
    open_buckets = labelled.groupBy("bucket", "hub_root").agg(F.count_if(F.col("root") != F.col("hub_root")).alias("out")).filter("out > 0")
    rest = stored(labelled.join(open_buckets.select("bucket"), "bucket"), name)
    closer = here = F.lit(True)
    if sharpen:
        facts, compare = sharpen(rest.select("id").distinct())
        # a pair may share many of these buckets: it is kept in the first of them
        meets = rest.groupBy("id").agg(F.collect_set("bucket").alias("meets"))
        rest, closer = stored(rest.join(facts, "id").join(meets, "id"), name), compare(F.col("l.s"), F.col("r.s"))
        here = F.array_min(F.array_intersect("l.meets", "r.meets")) == F.col("l.bucket")
    outside, inside = rest.filter("root != hub_root").alias("l"), rest.alias("r")
    once = (F.col("r.root") == F.col("r.hub_root")) | (F.col("l.id") < F.col("r.id"))
    across = outside.join(
        inside,
        (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.root") != F.col("r.root")) & once & closer & may_link(F.col("l.p"), F.col("r.p")) & here,
    )
    a, b = F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")
    more = across.select(a, b).distinct().join(tried, ["a", "b"], "left_anti")
    return components(links.union(confirm(stored(more, name))), name)


def sharing(members: DataFrame) -> DataFrame:
    """The rows of (bucket, id) whose bucket has other rows."""
    return members.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).filter("n > 1").select("bucket", "id")


def linked_by_sketch(
    live: list[DataFrame],
    sketches: DataFrame,
    may_link: Callable[[Column, Column], Column],
    confirm: Callable[[DataFrame], DataFrame],
    name: str,
) -> DataFrame:
    """(id, root) of items with a link, for items that a sketch of some bytes nearly decides.

    Rounds are those of ``linked``; ``live`` has the rows of ``sharing`` in parts with whole buckets, stored, and is emptied,
    ``sketches`` has (id, p), and ``confirm`` keeps the linked of pairs (a, b). The hub of a bucket is its smallest id, so
    it takes no shuffle to find it, and sketches travel with the rows of shared buckets, once in each round, one part
    after the other: the disk for it is that of a part.
    """

    def of_all(pairs: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, [stored(pairs(part), name) for part in live]).distinct()

    hub = Window.partitionBy("bucket").orderBy("id")

    def with_hub(part: DataFrame) -> DataFrame:
        met = part.join(sketches, "id").withColumns({"hub": F.first("id").over(hub), "hub_p": F.first("p").over(hub)})
        near = met.filter((F.col("id") != F.col("hub")) & may_link(F.col("p"), F.col("hub_p")))
        return near.select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()

    tried = stored(of_all(with_hub), name)
    links = stored(confirm(tried), name)
    groups = components(links, name)

    rooted = sketches.join(groups, "id", "left").select("id", "p", F.coalesce("root", "id").alias("root"))

    def others(part: DataFrame) -> DataFrame:
        placed = part.join(rooted, "id").withColumn("hub_root", F.first("root").over(hub))
        outside, inside = placed.filter("root != hub_root").alias("l"), placed.alias("r")
        once = (F.col("r.root") == F.col("r.hub_root")) | (F.col("l.id") < F.col("r.id"))
        across = outside.join(
            inside, (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.root") != F.col("r.root")) & once & may_link(F.col("l.p"), F.col("r.p"))
        )
        return across.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()

    more = stored(of_all(others).join(tried, ["a", "b"], "left_anti"), name)
    for part in live:
        emptied(part)
    return components(links.union(confirm(more)), name)
