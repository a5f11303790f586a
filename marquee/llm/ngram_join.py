"""Exact Jaccard join of documents on word n-grams, with skips from set relations.

A document is the set of its distinct 4-word shingles (lower-case A-Z); documents with one
set are one class. All shingles have one global order, rare before frequent, and a class
is listed under the first shingles of its order (its prefix) only: two classes with the
similarity asked for share a shingle of their prefixes. Lists are read with two skips:

* *Index level.* The entries of a list lie in blocks by set size and position. Two entries
  at positions i and j allow an overlap of at most 1 + min(i, j) + min(what follows); blocks
  whose bounds exclude every pair are skipped unread, then single pairs are.
* *Answer level.* The list's hub, the class that shares most with others, is answered
  first: its exact overlap with every class of the list. The answers of a class similar to
  the hub follow from those: with o = |x & h| and p = |y & h|, o + p - |h| <= |x & y| <=
  min(o, p) + min(|x| - o, |y| - p). Only pairs that these bounds leave open, and that are not
  connected yet, are compared on their full sets.

Frequent shingles are counted exactly over all documents, in packed arrays. At most ``MOST_FREQUENT``
of them, the most frequent ones, are put at the end of the order; every choice of them gives
the same links, only the work differs.

Defined cases: a text with fewer than four words is one shingle; a null text or one without
words has no shingle and is linked with nothing. Rows equal in id are separate rows; a null id
comes after all others, and such a row has the smallest id of its group. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import may_contain, whole_text
from marquee.llm.linking import components
from marquee.operators.lineage import stored

WORDS = 4
#: A shingle counts as frequent from so many rows on ...
FREQUENT = 16
#: ... and so many of them are sent to every task at most (8 bytes each).
MOST_FREQUENT = 2**18
#: Bits of the parity map that bounds how far two sets differ.
PARITY_BITS = 1024
#: Shingles that a task gathers before it sends a run.
_FLUSH = 2**19

_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    mix = each[:n] * _STEP[0]
    for i in range(1, WORDS):
        mix = _mixed(mix) + each[i : n + i] * _STEP[i]
    return np.unique(_mixed(mix))


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part, [shingles(t) for t in part.column("text").cast(pa.binary()).to_pylist()]


def _split(tokens: np.ndarray, ranges: int) -> list[np.ndarray]:
    """Sorted tokens by range of their value."""
    width = 2**64 // ranges + 1
    edges = np.array([i * width for i in range(1, ranges)], np.uint64)
    return np.split(tokens, np.searchsorted(tokens, edges))


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent shingles, counted over all rows.

    Tasks send sorted runs of hashes with their counts, one row for each range of values;
    a range is summed in one task. A shingle of a third of all rows is one number of a run.
    """
    spark = docs.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            parts = _split(tokens, ranges)
            starts = np.cumsum([0, *map(len, parts)])
            packed = [counts[a:b].astype("<u4").tobytes() for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(ranges), pa.int32()), pa.array([p.astype("<u8").tobytes() for p in parts], pa.binary()), pa.array(packed, pa.binary())],
                names=["range", "tokens", "counts"],
            )

        held, size = [], 0
        for _, sets in _texts(batches):
            held += sets
            size += sum(map(len, sets))
            if size >= _FLUSH:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            more = [np.frombuffer(b"".join(batch.column(c).to_pylist()), kind) for c, kind in (("tokens", "<u8"), ("counts", "<u4"))]
            tokens, at = np.unique(np.concatenate([tokens, more[0]]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, more[1]]), len(tokens)).astype(np.int64)
        often = counts >= FREQUENT
        yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], names=["token", "rows"])

    texts = docs.select(whole_text().alias("text"))
    counted = texts.mapInArrow(runs, "range int, tokens binary, counts binary").groupBy("range").applyInArrow(sums, "token bigint, rows bigint")
    counted = stored(counted, "frequent")
    # the lowest count at which the bound on their number holds; counts are grouped by powers of 2
    step = F.floor(F.log2(F.col("rows").cast("double"))).cast("int").alias("step")
    least, total = None, 0
    for row in counted.groupBy(step).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > MOST_FREQUENT:
            break
        least = row["step"]
    if least is None:
        return np.empty(0, np.uint64)
    chosen = counted.filter(step >= least).select("token").toArrow()
    return np.sort(chosen.column("token").to_numpy().view(np.uint64))


def prefix(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set in the global order; any set similar enough shares one of its own."""
    length = len(tokens) - -(-percent * len(tokens) // 100) + 1
    if not len(frequent):
        return tokens[:length]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    late = frequent[at] == tokens
    first = tokens[~late][:length]
    return np.concatenate([first, tokens[late][: length - len(first)]])


def parity(tokens: np.ndarray) -> np.ndarray:
    """A bit is set if an odd number of shingles falls on it; two sets differ in as many shingles as bits at least."""
    odd = np.bincount((tokens % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, row, check, text): two hashes name a row by its id and text."""
    text = whole_text()
    return docs.select("doc_id", F.xxhash64("doc_id", text).alias("row"), F.hash("doc_id", text).alias("check"), text.alias("text"))


def describe(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """(doc_id, row, check, n, set_key, prefix, parity) of every row; no set_key without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _texts(batches):
            found = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("row"), part.column("check"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if f else None for s, f in zip(sets, found)], pa.binary()),
                    pa.array([prefix(s, frequent, percent).view(np.int64) if f else None for s, f in zip(sets, found)], pa.list_(pa.int64())),
                    pa.array([parity(s) if f else None for s, f in zip(sets, found)], pa.list_(pa.int64())),
                ],
                names=["doc_id", "row", "check", "n", "set_key", "prefix", "parity"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, row bigint, check int, n bigint, set_key binary, prefix array<bigint>, parity array<bigint>"
    return _named(docs).mapInArrow(run, columns)


def _least_overlap(n: Column, m: Column, percent: int) -> Column:
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


class _Overlaps:
    """Exact overlaps of pairs of classes, from their texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, name: str):
        self.docs, self.classes, self.name = _named(docs).drop("doc_id"), classes, name

    def _sets(self, wanted: DataFrame, kept: str) -> DataFrame:
        """(id, kept, tokens) of wanted rows (id, kept), each from the one text that stands for its class."""
        spots = stored(wanted.join(self.classes.select("id", "row", "check"), "id"), self.name)
        rows = self.docs.filter(may_contain(spots, "row")(F.col("row")))
        texts = rows.join(spots, ["row", "check"]).dropDuplicates(["id", kept]).select("id", kept, "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, sets in _texts(batches):
                tokens = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column(kept), tokens], names=["id", kept, "tokens"])

        kind = wanted.schema[kept].dataType.simpleString()
        return texts.mapInArrow(run, f"id bigint, {kept} {kind}, tokens array<bigint>")

    def of(self, pairs: DataFrame) -> DataFrame:
        """(a, b, common) of pairs (a, b); the set of ``a`` travels to ``b``.

        A class with many partners is read once for every 256 of them or so.
        """
        fan = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).alias("parts"))
        part = F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
        partners = pairs.join(fan, "a").select("a", "b", part).groupBy("a", "part").agg(F.sort_array(F.collect_list("b")).alias("to"))
        sent = self._sets(partners.select(F.col("a").alias("id"), "to"), "to")
        sent = sent.select(F.col("id").alias("a"), F.explode("to").alias("b"), F.col("tokens").alias("ta"))
        held = self._sets(pairs.select(F.col("b").alias("id"), F.lit(0).alias("own")).distinct(), "own")
        both = sent.join(held.select(F.col("id").alias("b"), F.col("tokens").alias("tb")), "b")
        return both.select("a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"))


def ngram_links(docs: DataFrame, percent: int = 85, name: str = "ngrams") -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, set_key), and groups (set_key, root) of classes that are linked.

    Classes are linked with 100 * |intersection| >= percent * |union|.
    """
    described = stored(describe(docs, frequent_shingles(docs), percent), name)
    one = F.min_by(F.struct("row", "check", "n", "prefix", "parity"), F.struct("row", "check")).alias("one")
    classes = described.filter("n > 0").groupBy("set_key").agg(one).select("set_key", "one.*")
    classes = stored(classes.select(F.monotonically_increasing_id().alias("id"), "set_key", "n", "row", "check", "prefix", "parity"), name)
    entries = classes.select(F.posexplode("prefix").alias("pos", "token"), "id", "n")
    lists = stored(entries.groupBy("token").agg(F.count(F.lit(1)).alias("length")).filter("length > 1"), name)
    live = stored(entries.filter(may_contain(lists, "token")(F.col("token"))).join(lists, "token"), name)
    overlaps = _Overlaps(docs, classes, name)
    facts = classes.select("id", "n", "parity")

    def enough(n: Column, m: Column, common: Column) -> Column:
        return common * 100 >= (n + m - common) * percent

    def left_open(n: Column, m: Column, p: Column, q: Column) -> Column:
        """Whether the parity maps allow the similarity."""
        differ = F.lit(0)
        for i in range(PARITY_BITS // 64):
            differ = differ + F.bit_count(p[i].bitwiseXOR(q[i]))
        return enough(n, m, F.floor((n + m - differ) / 2))

    def in_reach(pairs: DataFrame) -> DataFrame:
        """(a, b, na, nb) of pairs that the parity maps leave open."""
        x, y = (facts.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("parity").alias(f"p{k}")) for k in "ab")
        near = left_open(F.col("na"), F.col("nb"), F.col("pa"), F.col("pb"))
        return pairs.join(x, "a").join(y, "b").filter(near).select("a", "b", "na", "nb")

    def meet(n: Column, i: Column, m: Column, j: Column) -> Column:
        """Whether two entries of a list can be of similar sets."""
        most = 1 + F.least(i, j) + F.least(n - i, m - j) - 1
        return _sizes_fit(n, m, percent) & (most >= _least_overlap(n, m, percent))

    mass = live.groupBy("id").agg(F.sum("length").alias("mass"))
    live = stored(live.join(mass, "id").drop("length"), name)

    def answered(entries: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """The hub of each list, and (a, b, na, nb, common) of entries ``a`` and hubs ``b`` that can be similar."""
        hub = F.max(F.struct("mass", "id", "n", "pos")).alias("h")
        hubs = entries.groupBy("token").agg(hub).select("token", F.col("h.id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.pos").alias("hub_pos"))
        hubs = stored(hubs, name)
        near = entries.join(hubs, "token").filter("id != hub").filter(meet(F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos")))
        pairs = near.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
        tried = stored(in_reach(pairs if known is None else pairs.join(known, ["a", "b"], "left_anti")), name)
        return hubs.select("token", "hub", "hub_n"), stored(overlaps.of(tried.select("a", "b")).join(tried, ["a", "b"]), name)

    def links_of(answers: DataFrame) -> DataFrame:
        return answers.filter(enough(F.col("na"), F.col("nb"), F.col("common"))).select("a", "b")

    def outside(groups: DataFrame) -> DataFrame:
        """Entries of lists that are not in one group, with their group and the one of the list's hub."""
        root = F.coalesce("root", "id").alias("root")
        rooted = live.join(groups, "id", "left").select("token", "id", "n", "pos", "mass", root)
        at = hubs.join(groups.withColumnRenamed("id", "hub"), "hub", "left").select("token", "hub", "hub_n", F.coalesce("root", "hub").alias("hub_root"))
        rooted = rooted.join(at, "token").withColumn("open", F.col("root") != F.col("hub_root"))
        lists = rooted.filter("open").select("token").distinct()
        return stored(rooted.join(lists, "token"), name)

    hubs, answers = answered(live, None)
    groups = components(links_of(answers), name)
    # entries outside the hub's group get a second hub, which joins most of them to one group
    _, more = answered(outside(groups).filter("open").select("token", "id", "n", "pos", "mass"), answers)
    links = stored(links_of(answers.unionByName(more)), name)
    shared = outside(components(links, name))

    # what the hub's answers say about its list; the hub is its own answer
    told = answers.select(F.col("a").alias("id"), F.col("b").alias("hub"), "common")
    shared = shared.join(told, ["id", "hub"], "left").withColumn("common", F.when(F.col("id") == F.col("hub"), F.col("n")).otherwise(F.col("common")))
    block = F.floor(F.log(F.col("n").cast("double")) * 8) * 64 + F.floor(F.col("pos") * 32 / F.col("n"))
    shared = stored(shared.withColumn("block", block.cast("int")).join(facts.select("id", "parity"), "id"), name)
    bounds = shared.groupBy("token", "block").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("pos").alias("i1"), F.max(F.col("n") - F.col("pos")).alias("r1"), F.bool_or("open").alias("open")
    )
    left, right = (bounds.select("token", *[F.col(c).alias(f"{c}{k}") for c in ("block", "n0", "n1", "i1", "r1", "open")]) for k in "lr")
    most = F.least("i1l", "i1r") + F.least("r1l", "r1r")
    fit = (F.col("n1l") * 100 >= F.col("n0r") * percent) & (F.col("n1r") * 100 >= F.col("n0l") * percent)
    blocks = left.filter("openl").join(right, "token").filter(fit & (most >= _least_overlap(F.col("n0l"), F.col("n0r"), percent)))
    blocks = blocks.select("token", F.col("blockl").alias("block"), "blockr")
    x = shared.filter("open").join(blocks, ["token", "block"])
    x = x.select("token", F.col("blockr").alias("block"), *[F.col(c).alias(f"{c}_x") for c in ("id", "n", "pos", "root", "common", "parity")])
    y = shared.select("token", "block", "hub_n", *[F.col(c).alias(f"{c}_y") for c in ("id", "n", "pos", "root", "common", "parity", "open")])
    least = _least_overlap(F.col("n_x"), F.col("n_y"), percent)
    most = F.least("common_x", "common_y") + F.least(F.col("n_x") - F.col("common_x"), F.col("n_y") - F.col("common_y"))
    surely = F.col("common_x") + F.col("common_y") - F.col("hub_n")
    once = ~F.col("open_y") | (F.col("id_x") < F.col("id_y"))
    met = meet(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y"))
    met = met & left_open(F.col("n_x"), F.col("n_y"), F.col("parity_x"), F.col("parity_y"))
    both = x.join(y, ["token", "block"]).filter((F.col("root_x") != F.col("root_y")) & once & met & F.coalesce(most >= least, F.lit(True)))
    sure = F.max(F.coalesce(enough(F.col("n_x"), F.col("n_y"), surely), F.lit(False))).alias("sure")
    both = stored(both.groupBy(F.col("id_x").alias("a"), F.col("id_y").alias("b"), F.col("n_x").alias("na"), F.col("n_y").alias("nb")).agg(sure), name)
    seen = answers.unionByName(more).select("a", "b")
    seen = seen.union(seen.select("b", "a"))
    rest = stored(both.filter("NOT sure").select("a", "b", "na", "nb").join(seen, ["a", "b"], "left_anti"), name)
    last = links_of(overlaps.of(rest.select("a", "b")).join(rest, ["a", "b"]))
    groups = components(links.union(both.filter("sure").select("a", "b")).union(last), name)
    keys = classes.select("id", "set_key")
    named = groups.join(keys, "id").join(keys.select(F.col("id").alias("root"), F.col("set_key").alias("root_key")), "root")
    return described.select("doc_id", "n", "set_key"), named.select("set_key", F.col("root_key").alias("root"))


def linked_documents(docs: DataFrame, percent: int = 85, name: str = "ngrams") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; a component has the smallest id in reach."""
    rows, groups = ngram_links(docs, percent, name)
    rooted = rows.join(groups, "set_key", "left").select("doc_id", "n", F.coalesce("root", "set_key").alias("group"))
    least = rooted.filter("`group` IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("least"))
    out = rooted.join(least, "group", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
