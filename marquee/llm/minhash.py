"""Near-duplicate documents with b-bit MinHash.

A document is the set of its distinct 5-word shingles (lower-case A-Z). Documents with
one set are one class from the start. Each class has 112 minima; bands of four name its
buckets, and the lowest two bits of every minimum, packed in bit planes, make its
signature. Two classes in one bucket are compared by counting equal lanes; the chance of
agreeing by accident, 1/4, is taken out of the estimate. Only pairs whose estimate lies
more than 5.5 standard deviations below the threshold leave; the others are confirmed on
their full sets. A pair at similarity 0.85 meets in some bucket with probability 1 - 1e-9.

Defined cases: a text with fewer than five words is one shingle, a null text or one
without words has no shingle, is linked with nothing and kept. Rows equal in id are
separate rows and all kept if their id is the smallest of the group; a null id comes
after all others and its row is not kept if its group has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import may_contain, text_key, whole_text
from marquee.llm.linking import linked
from marquee.operators.lineage import stored

WORDS = 5
BAND_ROWS = 4
BANDS = 28
LANES = BAND_ROWS * BANDS
BITS = 2
#: Standard deviations below the threshold at which a pair is given up unconfirmed.
MARGIN = 5.5

_random = np.random.default_rng(20_240_229)
_MULTIPLY = _random.integers(0, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 2**63, LANES, dtype=np.uint64)
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    mix = each[:n] * _STEP[0]
    for i in range(1, WORDS):
        mix = _mixed(mix) + each[i : n + i] * _STEP[i]
    return np.unique(_mixed(mix))


def minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(LANES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        np.minimum(low, (_MULTIPLY[:, None] * part[None, :] + _ADD[:, None]).min(axis=1), out=low)
    return low


def signatures(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and packed low bits from rows of minima."""
    bands = low.reshape(len(low), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _STEP[3], (len(low), BANDS)).copy()
    for i in range(BAND_ROWS):
        key = _mixed(key ^ bands[:, :, i]) + _STEP[i]
    # the top bits of a product are its well-mixed ones; the minima themselves are small, so mix before cutting bits
    bits = _mixed(low)
    planes = [np.packbits(((bits >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1) for b in range(BITS)]
    padded = [np.pad(p, ((0, 0), (0, 16 - p.shape[1]))) for p in planes]
    return key.astype(np.int64), np.concatenate(padded, axis=1).view("<i8")


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, bands, bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts, keys, lows = [], [], []
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    found = shingle_set(text)
                    counts.append(len(found))
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    lows.append(minima(found))
                bands, bits = signatures(np.array(lows))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("text_key"), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                        _lists(bands), _lists(bits),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "bands", "bits"],
                )

    rows = docs.select("doc_id", text_key().alias("text_key"), whole_text().alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, text_key binary, n_shingles bigint, set_key binary, bands array<bigint>, bits array<bigint>"
    )


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).reshape(-1)))


def estimated_similarity(x: Column, y: Column) -> Column:
    """Similarity from two packed signatures, corrected for accidental agreement."""
    per_plane = 2
    differ = F.lit(0)
    for word in range(per_plane):
        unlike = [x[b * per_plane + word].bitwiseXOR(y[b * per_plane + word]) for b in range(BITS)]
        either = unlike[0]
        for other in unlike[1:]:
            either = either.bitwiseOR(other)
        differ = differ + F.bit_count(either)
    accident = 0.5**BITS
    return (1 - differ / LANES - accident) / (1 - accident)


def lowest_estimate(similarity: float) -> float:
    accident = 0.5**BITS
    agree = accident + (1 - accident) * similarity
    return similarity - MARGIN * (agree * (1 - agree) / LANES) ** 0.5 / (1 - accident)


def _shingles(texts: DataFrame) -> DataFrame:
    """(id, shingles) from (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(t).astype(np.int64) for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.list_(pa.int64()))], names=["id", "shingles"])

    return texts.mapInArrow(run, "id binary, shingles array<bigint>")


def near_duplicates(docs: DataFrame, percent: int = 85, name: str = "minhash") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every row.

    Documents with 100 * |intersection| >= percent * |union| are linked; a component has
    the smallest id that can be reached.
    """
    described = stored(describe(docs), name)
    classes = described.filter("n_shingles > 0").select(F.col("set_key").alias("id"), "text_key", "n_shingles", "bands", "bits")
    classes = stored(classes.dropDuplicates(["id"]), name)
    members = classes.select(F.explode("bands").alias("bucket"), "id")
    payload = classes.select("id", F.struct("bits", F.col("n_shingles").alias("n")).alias("p"))
    least = lowest_estimate(percent / 100)

    def may_link(x: Column, y: Column) -> Column:
        sizes = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent
        return sizes & (estimated_similarity(x["bits"], y["bits"]) >= least)

    held: dict[str, DataFrame] = {}

    def prepare(live: DataFrame):
        wanted = stored(classes.join(live, "id").select("id", "text_key"), name)
        texts = docs.select(text_key().alias("text_key"), whole_text().alias("text"))
        texts = texts.filter(may_contain(wanted, "text_key")(F.col("text_key"))).join(wanted, "text_key")
        sets = held["sets"] = stored(_shingles(texts.dropDuplicates(["id"]).select("id", "text")), name)

        def confirm(pairs: DataFrame) -> DataFrame:
            left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
            right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
            common = F.size(F.array_intersect("sa", "sb"))
            union = F.size("sa") + F.size("sb") - common
            return pairs.join(left, "a").join(right, "b").filter(common * 100 >= union * percent).select("a", "b")

        return confirm

    def sharpen(left: DataFrame):
        """Shingles that no other of these classes has can't be common to a pair."""
        mine = held["sets"].join(left, "id")
        each = mine.select(F.xxhash64("id").alias("owner"), F.explode("shingles").alias("shingle"))
        once = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("owner")).filter("n = 1")
        own = once.groupBy("owner").agg(F.count(F.lit(1)).alias("own"))
        facts = mine.select("id", F.size("shingles").alias("n"), F.xxhash64("id").alias("owner")).join(own, "owner", "left")
        shared = F.col("n") - F.coalesce("own", F.lit(0))

        def compare(x: Column, y: Column) -> Column:
            common = F.least(x["shared"], y["shared"])
            return common * 100 >= (x["n"] + y["n"] - common) * percent

        return facts.select("id", F.struct("n", shared.alias("shared")).alias("s")), compare

    roots = linked(members, payload, may_link, prepare, name, sharpen).withColumnRenamed("id", "set_key")
    rows = described.select("doc_id", "text_key", "n_shingles", "set_key").join(roots, "set_key", "left")
    group = F.coalesce("root", "set_key")
    rows = rows.select("doc_id", "text_key", "n_shingles", group.alias("grp"))
    smallest = rows.filter("grp IS NOT NULL").groupBy("grp").agg(F.min("doc_id").alias("least_id"))
    out = rows.join(smallest, "grp", "left").withColumn("component_id", F.coalesce("least_id", "doc_id"))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
