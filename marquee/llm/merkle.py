"""Merkle manifest of a dataset as nested structs.

Rows are ranked within their group, and the digits of the rank become columns. Grouping the lowest
digit away turns a run of siblings into their parent, which holds them as nested structs; this
is done digit by digit within blocks of a bounded number of leaves, so a block is one row and
its rows are shuffled once, however large its group is. The tops of blocks are the leaves of the next
tier. On the way down a block meets the path above it by one more grouping, and one
transform and explode emits every proof: there is no join of leaves with hashes.

A parent is the SHA-256 of its children's digests as hex text; a run at the end may be shorter,
even one node. A group's last node is its subroot; subroots, ordered by group, likewise give
the root.

Defined cases: null fields are written as ``-``, a null group comes first, null order columns
come first; rows that tie are ordered by their leaf, and rows equal in all of that are
interchangeable. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.lineage import stored

#: Leaves of a block at most. Code for structs nested deeper takes the compiler gigabytes.
BLOCK_LEAVES = 16
#: Ranks stay below 2**62.
_RANK_BITS = 62


def field(value: Column) -> Column:
    """A field as text that cannot be mistaken for other fields: its length in bytes and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*values: Column) -> Column:
    return F.sha2(F.concat(*values), 256)


def _ranked(rows: DataFrame, order: Sequence[str], arity: int, name: str) -> DataFrame:
    """Add ``rank`` (from 0 within ``grp``) and ``height``, the levels above the leaves of the group.

    Rows are cut into ranges of group and order; the counts of ranges give the first rank of each.
    """
    keyed = stored(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    cut = keyed.repartitionByRange("grp", *order, "_row").withColumn("_cell", F.spark_partition_id())
    cut = stored(cut, name)
    counts = cut.groupBy("grp", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("grp").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(Window.partitionBy("grp"))
    powers, power = [], 1
    while power < 2**_RANK_BITS:
        powers.append(power)
        power *= arity
    height = sum(((F.col("_total") > F.lit(p)).cast("int") for p in powers), F.lit(0))
    cells = counts.select("grp", "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"), total.alias("_total"))
    cells = cells.select("grp", "_cell", "_first", height.alias("height"))
    place = F.row_number().over(Window.partitionBy("grp", "_cell").orderBy(*order, "_row"))
    return cut.join(cells, ["grp", "_cell"]).withColumn("rank", F.col("_first") + place - 1).drop("_row", "_cell", "_first")


def _blocks(nodes: DataFrame, arity: int, levels: int, below: int) -> DataFrame:
    """(grp, height, block, hash, kids): nodes (grp, height, rank, hash, item) rolled up by ``levels`` digits.

    The nodes lie ``below`` levels above the leaves. A level above the group's last one passes its node on.
    """
    size = arity**levels
    digits = [F.floor(F.col("rank") / arity**k).cast("long") % arity for k in range(levels)]
    now = nodes.select("grp", "height", F.floor(F.col("rank") / size).cast("long").alias("block"), *[d.cast("int").alias(f"d{k}") for k, d in enumerate(digits)], "hash", "item")
    # one shuffle; the keys of every roll-up begin with these
    now = now.repartition("grp", "block")
    inner = "item"
    for k in range(levels):
        kids = F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "hash", inner)))
        now = now.groupBy("grp", "block", "height", *[f"d{i}" for i in range(k + 1, levels)]).agg(kids.alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda kid: kid["hash"]), ""), 256)
        now = now.withColumn("hash", F.when(F.col("height") > below + k, joined).otherwise(F.col("kids")[0]["hash"]))
        inner = "kids"
    return now.select("grp", "height", "block", "hash", "kids")


def _paths(kids: Column, above: Column, height: Column, level: int, below: int) -> Column:
    """(item, path) of all leaves under ``kids``; a path goes from the leaf to the root."""

    def of(kid: Column) -> Column:
        before = F.array_join(F.transform(F.filter(kids, lambda other: other["digit"] < kid["digit"]), lambda other: other["hash"]), "")
        after = F.array_join(F.transform(F.filter(kids, lambda other: other["digit"] > kid["digit"]), lambda other: other["hash"]), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        path = F.when(height > below + level, F.concat(step, above)).otherwise(above)
        if not level:
            return F.array(F.struct(kid["item"].alias("item"), path.alias("path")))
        return _paths(kid["kids"], path, height, level - 1, below)

    return F.flatten(F.transform(kids, of))


def _rolled(nodes: DataFrame, arity: int, levels: int, name: str) -> list[DataFrame]:
    """The tiers of blocks from the leaves up; in the last one each group has one block."""
    top = nodes.agg(F.max("height")).first()[0] or 0
    tiers, now = [], nodes
    for below in range(0, max(top, 1), levels):
        tiers.append(stored(_blocks(now, arity, levels, below), name))
        now = tiers[-1].select("grp", "height", F.col("block").alias("rank"), "hash", F.struct("grp", "block").alias("item"))
    return tiers


def _unrolled(tiers: list[DataFrame], above: DataFrame, levels: int, name: str) -> DataFrame:
    """(item, path, subroot, root) of every leaf; ``above`` (grp, block, path, subroot, root) tells the same of each group's top."""
    facts = ["path", "subroot", "root"]
    for tier in reversed(range(len(tiers))):
        blocks = tiers[tier].select("grp", "block", F.struct("height", "kids").alias("tree"))
        both = blocks.unionByName(above.select("grp", "block", F.struct(*facts).alias("up")), allowMissingColumns=True)
        met = both.groupBy("grp", "block").agg(F.any_value("tree", True).alias("tree"), F.any_value("up", True).alias("up"))
        paths = _paths(F.col("tree.kids"), F.col("up.path"), F.col("tree.height"), levels - 1, tier * levels)
        leaves = met.select("up.subroot", "up.root", F.explode(paths).alias("leaf")).select("leaf.item", "leaf.path", "subroot", "root")
        if not tier:
            return leaves
        above = stored(leaves.select("item.grp", "item.block", *facts), name)


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str, arity: int = 2, name: str = "merkle") -> DataFrame:
    """The rows with ``subroot``, ``root`` and ``proof``, the siblings ``before`` and ``after`` from the leaf to the root.

    ``leaf`` is the column of the rows' digests. Rows of a group ascend by ``order`` and the digest.
    """
    levels = 1
    while arity ** (levels + 1) <= BLOCK_LEAVES:
        levels += 1
    item = F.struct(*[F.col(c) for c in rows.columns])
    # a null group sorts before all texts
    key = F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    places = [f"o{i}" for i in range(len(order))]
    nodes = rows.select(key.alias("grp"), *[F.col(c).alias(p) for c, p in zip(order, places)], F.col(leaf).alias("hash"), item.alias("item"))
    nodes = _ranked(nodes, [*places, "hash"], arity, name).select("grp", "height", "rank", "hash", "item")
    tiers = _rolled(nodes, arity, levels, name)

    tops = tiers[-1].select(F.lit("").alias("grp"), "hash", F.struct("grp", F.col("hash").alias("subroot")).alias("item"), F.col("grp").alias("o0"))
    tops = _ranked(tops, ["o0"], arity, name).select("grp", "height", "rank", "hash", "item")
    roots = _rolled(tops, arity, levels, name)
    none = F.array().cast("array<struct<before:string,after:string>>")
    start = roots[-1].select("grp", "block", none.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    up = _unrolled(roots, start, levels, name)
    up = up.select("item.grp", F.lit(0).cast("long").alias("block"), "path", "item.subroot", "root")
    out = _unrolled(tiers, stored(up, name), levels, name)
    return out.select("item.*", "subroot", "root", F.col("path").alias("proof"))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def document_manifest(docs: DataFrame, name: str = "merkle") -> DataFrame:
    """Leaf, proof and root of every document, and the root recomputed after tampering with every seventh id.

    Tampering adds one to n_chars of documents whose id's CRC-32 is divisible by 7; a null
    n_chars stays, and a null id is not tampered with.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    odd = F.col("n_chars").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    leaf = digest(*[field(F.col(c)) for c in fields])
    changed = digest(*[field(F.col(c) + 1 if c == "n_chars" else F.col(c)) for c in fields])
    leaves = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(odd, changed).alias("changed"))
    proved = manifest(leaves, "lang", ["doc_id"], "leaf", 2, name)
    found = folded(F.coalesce("changed", "leaf"), F.col("proof"))
    out = proved.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), found.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
