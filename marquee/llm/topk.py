"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... segments. With mean m and deviation s of a segment of
length L, the squared distance of two vectors is at least the sum of
L (m1 - m2)^2 + L (s1 - s2)^2, which bounds the inner product from above by the sum of
L (m1 m2 + s1 s2). Bounds are taken coarse to fine; a pair leaves as soon as its bound
is below the query's k-th best score so far, and survivors get exact integer scores.

Queries and candidates are packed in blocks of a fixed size, and every pair of blocks is
one row of work, so memory does not depend on the table. A vector takes part in as many
rows as there are blocks of queries.

Defined cases: null vectors and vectors with null or non-finite components take no part;
only vectors of one length are compared; empty vectors score 0; ties go to the smaller
id; rows of one id are separate queries, each with its own k, and separate candidates, also
of each other; a null id is no query and, as candidate, comes last among ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.lineage import stored

QUERY_BLOCK = 4_096
CANDIDATE_BLOCK = 8_192
_STRIP = 512
_HELD_ROWS = 65_536
#: Stands for a null id inside blocks; sorts last.
_NO_ID = 2**63 - 1


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): floor(256 x) of each component, rows that take part only."""
    x = F.col(vector)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long"))
    return vectors.filter(x.isNotNull() & sound).select(F.col(key).cast("long").alias("id"), whole.alias("v"))


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(L) * (means, deviations); a dot product of two rows bounds that of the vectors."""
    parts = np.array_split(np.arange(x.shape[1]), segments)
    out = np.empty((x.shape[0], 2 * segments))
    for i, cols in enumerate(parts):
        own = x[:, cols].astype(np.float64)
        out[:, i] = own.mean(axis=1) * np.sqrt(len(cols))
        out[:, segments + i] = own.std(axis=1) * np.sqrt(len(cols))
    return out


def _levels(length: int) -> list[int]:
    return [s for s in (1, 2, 4, 8, 16) if 2 * s <= length]


def best_of_block(q_rows, q, c_rows, c_ids, c, k: int):
    """Indices (query, candidate) and scores of each query's k best in a block; a row is no candidate of its own."""
    best_score = np.full((len(q), k), np.iinfo(np.int64).min)
    best_at = np.full((len(q), k), -1)
    levels = _levels(q.shape[1]) if q.shape[1] else []
    stats = [(segment_statistics(q, s), segment_statistics(c, s)) for s in levels]
    norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)), np.sqrt((c.astype(np.float64) ** 2).sum(axis=1))
    for start in range(0, len(c), _STRIP):
        strip = slice(start, min(start + _STRIP, len(c)))
        floor = best_score[:, -1].astype(np.float64)
        alive = (q_rows[:, None] != c_rows[None, strip])
        rows, cols = None, None
        for n, (sq, sc) in enumerate(stats):
            slack = 1e-9 * (norms[0].max(initial=0) * norms[1].max(initial=0)) + 1e-6
            if rows is None:
                alive &= sq @ sc[strip].T + slack >= floor[:, None]
                if alive.mean() < 0.05 or n == len(stats) - 1:
                    rows, cols = np.nonzero(alive)
            else:
                keep = np.einsum("ij,ij->i", sq[rows], sc[strip][cols]) + slack >= floor[rows]
                rows, cols = rows[keep], cols[keep]
        if rows is None:
            rows, cols = np.nonzero(alive)
        if not len(rows):
            continue
        score = np.empty(len(rows), np.int64)
        for at in range(0, len(rows), 100_000):
            part = slice(at, at + 100_000)
            score[part] = np.einsum("ij,ij->i", q[rows[part]], c[strip][cols[part]])
        better = score >= best_score[rows, -1]
        rows, cols, score = rows[better], cols[better] + start, score[better]
        held_rows, held_k = np.nonzero(best_at >= 0)
        rows = np.concatenate([rows, held_rows])
        cols = np.concatenate([cols, best_at[held_rows, held_k]])
        score = np.concatenate([score, best_score[held_rows, held_k]])
        order = np.lexsort((c_ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        first = np.searchsorted(rows, rows, side="left")
        place = np.arange(len(rows)) - first
        kept = place < k
        best_score[rows[kept], place[kept]] = score[kept]
        best_at[rows[kept], place[kept]] = cols[kept]
    rows, places = np.nonzero(best_at >= 0)
    return rows, best_at[rows, places], best_score[rows, places]


def _packed(rows: DataFrame, side: str, blocks: int) -> DataFrame:
    """One row (side_block, length, side_rows, side_ids, side_v) per block and length; blocks are dealt by a hash of the row."""
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).repartition("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def packed() -> Iterator[pa.RecordBatch]:
            for (block, length), part in held.items():
                ids = np.array([r[0] for r in part], "<i8")
                own = np.array([r[2] for r in part], "<i8")
                v = np.array([r[1] for r in part], "<i8").reshape(len(part), length)
                narrow = "<i2" if np.abs(v).max(initial=0) < 2**15 else "<i8"
                yield pa.RecordBatch.from_pydict({
                    f"{side}_block": pa.array([block], pa.int32()), "length": pa.array([length], pa.int32()),
                    f"{side}_rows": pa.array([own.tobytes()], pa.binary()), f"{side}_ids": pa.array([ids.tobytes()], pa.binary()), f"{side}_v": pa.array([v.astype(narrow).tobytes()], pa.binary()),
                })
            held.clear()

        count = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "id", "v", "row"))
            for block, row_id, v, own in zip(*columns):
                held.setdefault((block, len(v)), []).append((_NO_ID if row_id is None else row_id, v, own))
                count += 1
                if count % _HELD_ROWS == 0:
                    yield from packed()
        yield from packed()

    return dealt.mapInArrow(run, f"{side}_block int, length int, {side}_rows binary, {side}_ids binary, {side}_v binary")


def _unpacked(ids: bytes, v: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, "<i8")
    width = len(v) // max(1, len(numbers) * length)
    return numbers, np.frombuffer(v, "<i2" if width == 2 else "<i8").reshape(len(numbers), length).astype(np.int64)


def top_k(vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query row.

    ``is_query`` makes a condition of the id column.
    """
    rows = stored(quantised(vectors, key, vector).withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = rows.filter(is_query(F.col("id")))
    n = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_query(F.col("id"))).alias("queries")).first()
    q_blocks, c_blocks = n["queries"] // QUERY_BLOCK + 1, n["rows"] // CANDIDATE_BLOCK + 1
    left = _packed(queries, "q", q_blocks).withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    right = _packed(rows, "c", c_blocks).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    # rows are blocks: the stated query set against all rows, block by block
    work = left.join(right, ["q_block", "c_block", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q = _unpacked(row["q_ids"], row["q_v"], row["length"])
                c_ids, c = _unpacked(row["c_ids"], row["c_v"], row["length"])
                q_rows, c_rows = (np.frombuffer(row[f"{side}_rows"], "<i8") for side in "qc")
                r, at, score = best_of_block(q_rows, q, c_rows, c_ids, c, k)
                yield pa.RecordBatch.from_pydict({"query_row": q_rows[r], "query_id": q_ids[r], "vec_id": c_ids[at], "score": score})

    found = work.mapInArrow(run, "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    vec_id = F.when(F.col("vec_id") != _NO_ID, F.col("vec_id"))
    return ranked.select("query_id", "rank", vec_id.alias("vec_id"), "score")
