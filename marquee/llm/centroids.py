"""Exact centroid clustering with heap-ordered bounds.

Every vector has an upper bound of the distance to its centroid and a lower bound of the
distance to any other. While centroids move, the gap between both shrinks by the drift of its
cluster and the largest drift of the others at most. That loss is the same for all vectors
of a cluster, so it is added up once per cluster, and each cluster of a block keeps a heap of its
vectors by gap plus the loss at the time of entry. A round pops vectors only as
long as the top of the heap is used up by the loss; popped vectors are compared with all centroids in
exact integers and pushed again, all others are not touched.

Vectors lie in blocks of bounded size, packed with their heaps. A round reads the blocks, writes
them to the other one of two places, and adds up the sums of clusters in each task; what
reaches the driver are the sums of the clusters, k times the number of components.

Defined cases: vectors that are null, of another length, or hold null or non-finite
components take no part. Rows of one id are separate vectors. With fewer vectors than centroids there
are as many centroids as vectors; a null id names a vector like an empty text. An empty
table gives no rows. A component beyond 2**27 in whole units is an error, as distances would
not fit their column. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.lineage import stored
from marquee.session import scratch_path

BLOCK_VECTORS = 4096
_LARGEST = 2**27
#: Components up to here keep products and sums of 64 or so of them exact in doubles.
_EXACT = 2**21


def whole_units(values: np.ndarray, scale: int) -> np.ndarray:
    units = np.floor(values.astype(np.float64) * scale)
    if units.size and np.abs(units).max() > _LARGEST:
        raise ValueError(f"a component exceeds {_LARGEST} in units of 1/{scale}")
    return units.astype(np.int64)


def packed_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """(ids, vecs): blocks of usable vectors in whole units."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_VECTORS):
                part = batch.slice(at, BLOCK_VECTORS)
                lists = part.column("embedding")
                fits = [n == size for n in lists.value_lengths().to_pylist()]
                part = part.filter(pa.array(fits, pa.bool_()))
                if not part.num_rows:
                    continue
                values = part.column("embedding").flatten()
                values = values.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
                finite = np.isfinite(values).all(axis=1)
                if finite.any():
                    ids = part.column("vec_id").filter(pa.array(finite))
                    units = whole_units(values[finite], scale).astype("<i4")
                    offsets = pa.array([0, len(ids)], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, ids), pa.array([units.tobytes()], pa.binary())], names=["ids", "vecs"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, f"ids array<{kind}>, vecs binary")


def first_centroids(vectors: DataFrame, k: int, size: int, scale: int, salt: str) -> np.ndarray:
    """The usable vectors with the k smallest digests of their ids; ties in the order of their components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = vectors.filter((F.size("embedding") == size) & finite)
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = usable.select(key.alias("key"), "embedding").orderBy("key", "embedding").limit(k).collect()
    return whole_units(np.array([r["embedding"] for r in rows], np.float64).reshape(len(rows), size), scale)


def squared_distances(vecs: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all vectors and centroids."""
    x, c = vecs.astype(np.int64), centroids.astype(np.int64)
    small = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) * np.sqrt(x.shape[1]) <= 8 * _EXACT
    inner = (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if small else x @ c.T
    return (x * x).sum(axis=1)[:, None] - 2 * inner + (c * c).sum(axis=1)[None, :]


def nearest(vecs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the first) and the gap to the next one."""
    square = squared_distances(vecs, centroids)
    best = square.argmin(axis=1)
    rows = np.arange(len(vecs))
    first = np.sqrt(square[rows, best].astype(np.float64))
    if len(centroids) == 1:
        return best, np.full(len(vecs), np.inf)
    square[rows, best] = np.iinfo(np.int64).max
    return best, np.sqrt(square.min(axis=1).astype(np.float64)) - first


class Block:
    """The vectors of a block, their clusters, and one heap of (gap and loss at entry, vector) per cluster."""

    def __init__(self, vecs: np.ndarray, centroids: np.ndarray):
        self.vecs = vecs
        self.cluster, gaps = nearest(vecs, centroids)
        self.sums = np.zeros(centroids.shape, np.int64)
        np.add.at(self.sums, self.cluster, vecs)
        self.counts = np.bincount(self.cluster, minlength=len(centroids))
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in centroids]
        for at, (c, gap) in enumerate(zip(self.cluster.tolist(), gaps.tolist())):
            self.heaps[c].append((gap, at))
        for heap in self.heaps:
            heapq.heapify(heap)

    def expired(self, loss: np.ndarray) -> np.ndarray:
        """Take the vectors off the heaps whose gap may be used up."""
        found = []
        for heap, lost in zip(self.heaps, loss.tolist()):
            limit = lost + 1e-9 * (1 + lost)  # what rounding may add up to
            while heap and heap[0][0] <= limit + 1e-9 * heap[0][0]:
                found.append(heapq.heappop(heap)[1])
        return np.array(sorted(found), np.int64)

    def move(self, centroids: np.ndarray, loss: np.ndarray) -> int:
        """Assign the expired vectors again; returns how many were compared."""
        again = self.expired(loss)
        if len(again):
            new, gaps = nearest(self.vecs[again], centroids)
            old = self.cluster[again]
            left = new != old
            np.add.at(self.sums, new[left], self.vecs[again[left]])
            np.subtract.at(self.sums, old[left], self.vecs[again[left]])
            self.counts += np.bincount(new, minlength=len(centroids)) - np.bincount(old, minlength=len(centroids))
            self.cluster[again] = new
            for at, c, gap in zip(again.tolist(), new.tolist(), (gaps + loss[new]).tolist()):
                heapq.heappush(self.heaps[c], (gap, at))
        return len(again)

    _COLUMNS = "cluster binary, sizes binary, keys binary, places binary, sums binary, counts binary, compared bigint"

    def packed(self, compared: int) -> list[pa.Array]:
        flat = [entry for heap in self.heaps for entry in heap]
        keys, places = (np.array([e[i] for e in flat], kind) for i, kind in ((0, "<f8"), (1, "<i4")))
        sizes = np.array([len(h) for h in self.heaps], "<i4")
        parts = [self.cluster.astype("<i4"), sizes, keys, places, self.sums.astype("<i8"), self.counts.astype("<i8")]
        return [*[pa.array([p.tobytes()], pa.binary()) for p in parts], pa.array([compared], pa.int64())]

    @classmethod
    def unpacked(cls, row: dict, size: int, k: int) -> Block:
        block = cls.__new__(cls)
        block.vecs = np.frombuffer(row["vecs"], "<i4").reshape(-1, size).astype(np.int64)
        block.cluster = np.frombuffer(row["cluster"], "<i4").astype(np.int64)
        block.sums = np.frombuffer(row["sums"], "<i8").reshape(k, size).copy()
        block.counts = np.frombuffer(row["counts"], "<i8").copy()
        keys, places = np.frombuffer(row["keys"], "<f8").tolist(), np.frombuffer(row["places"], "<i4").tolist()
        block.heaps, at = [], 0
        for n in np.frombuffer(row["sizes"], "<i4").tolist():
            block.heaps.append(list(zip(keys[at : at + n], places[at : at + n])))
            at += n
        return block


def _steps(blocks: DataFrame, centroids: np.ndarray, loss: np.ndarray | None) -> DataFrame:
    """The blocks after one assignment; without ``loss`` it is the first."""
    k, size = centroids.shape
    names = ["ids", "vecs", *[c.split()[0] for c in Block._COLUMNS.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                row = {c: part.column(c)[0].as_py() for c in part.schema.names if c != "ids"}
                if loss is None:
                    block = Block(np.frombuffer(row["vecs"], "<i4").reshape(-1, size).astype(np.int64), centroids)
                    compared = len(block.vecs)
                else:
                    block = Block.unpacked(row, size, k)
                    compared = block.move(centroids, loss)
                yield pa.RecordBatch.from_arrays([part.column("ids"), part.column("vecs"), *block.packed(compared)], names=names)

    kind = blocks.schema["ids"].dataType.simpleString()
    return blocks.mapInArrow(run, f"ids {kind}, vecs binary, {Block._COLUMNS}")


def _sums(state: DataFrame, k: int, size: int) -> list[list[int]]:
    """Per cluster the sums of all components, and the count at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for batch in batches:
            for sums, counts in zip(batch.column("sums").to_pylist(), batch.column("counts").to_pylist()):
                total[:, :size] += np.frombuffer(sums, "<i8").reshape(k, size)
                total[:, size] += np.frombuffer(counts, "<i8")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.reshape(-1))], names=["at", "part"])

    parts = state.select("sums", "counts").mapInArrow(run, "at int, part bigint")
    rows = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("whole")).collect()
    found = [0] * (k * (size + 1))
    for row in rows:
        found[row["at"]] = int(row["whole"])
    return [found[c * (size + 1) : (c + 1) * (size + 1)] for c in range(k)]


def _moved(centroids: np.ndarray, sums: list[list[int]]) -> np.ndarray:
    """Means of the clusters, rounded down; an empty cluster stays."""
    return np.array([[s // row[-1] for s in row[:-1]] if row[-1] else old.tolist() for row, old in zip(sums, centroids)], np.int64)


def _loss(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How much a gap can shrink: the drift of the own centroid and the largest one of the others."""
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1))
    order = np.argsort(drift)
    others = np.full(len(drift), drift[order[-1]])
    others[order[-1]] = drift[order[-2]] if len(drift) > 1 else 0.0
    return drift + others


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2:", name: str = "centroids"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, compared) of usable vectors (vec_id, embedding), and the final centroids.

    ``compared`` tells how many vectors of the row's block the last round compared with all centroids.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(vectors, k, size, scale, salt)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, cluster int, distance bigint, compared bigint"), centroids
    spark = vectors.sparkSession
    places = [scratch_path(spark, name) for _ in range(2)]

    def kept(state: DataFrame, turn: int) -> DataFrame:
        # the state before the last one is no longer read, and its place is used again
        state.write.mode("overwrite").parquet(places[turn % 2])
        return spark.read.schema(state.schema).parquet(places[turn % 2])

    state = kept(_steps(packed_vectors(vectors, size, scale), centroids, None), 0)
    loss = np.zeros(len(centroids))
    for turn in range(1, rounds + 1):
        moved = _moved(centroids, _sums(state, *centroids.shape))
        loss = loss + _loss(centroids, moved)
        centroids = moved
        state = kept(_steps(state, centroids, loss), turn)

    final = centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                part = batch.slice(at, 1)
                vecs = np.frombuffer(part.column("vecs")[0].as_py(), "<i4").reshape(-1, size).astype(np.int64)
                own = np.frombuffer(part.column("cluster")[0].as_py(), "<i4")
                distance = ((vecs - final[own]) ** 2).sum(axis=1)
                compared = pa.array(np.full(len(own), part.column("compared")[0].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([part.column("ids").flatten(), pa.array(own), pa.array(distance), compared], names=["vec_id", "cluster", "distance", "compared"])

    rows = state.select("ids", "vecs", "cluster", "compared")
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint, compared bigint"), final


def clusters_with_inertia(vectors: DataFrame, k: int = 40, rounds: int = 5, name: str = "centroids") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of usable vectors."""
    spark = vectors.sparkSession
    rows, centroids = cluster(vectors, k, rounds, name=name)
    rows = stored(rows, name)
    # one row per centroid
    sums = {r["cluster"]: r["inertia"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    whole = sum(sums.values())
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame(
        [(c, sums[c], whole, names[c]) for c in sorted(sums)], "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
