"""Byte-level BPE over overlapping chunks.

A text longer than one chunk is cut into chunks that overlap. Each chunk is pre-tokenised
on its own, in parallel. Whether a match starts at some place depends only on the text
from there on, so as soon as two neighbouring chunks both have a boundary at one place of
their overlap, they agree from there on: the text is cut there, and the pieces are
encoded in parallel and put together in order. A cut is only made after a character that
is not white space, and away from the end of a chunk, where matches may look ahead. If
some overlap has no such place, the neighbours are joined to one piece, so the result is
exact for every text. Texts within one chunk are encoded where they are read.

Decoding concatenates the bytes of the ids. ``round_trip`` encodes and decodes a text in one Python
worker, so a task never runs two with tables of their own, and no ids are shuffled but those of pieces.

Defined cases: a null or empty text has no ids; equal long texts are encoded once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import text_key, whole_text

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
#: Matches that end this close to the end of a chunk may depend on what follows.
LOOK_AHEAD = 4

#: Bytes of matches and their ids that a worker remembers, about; an entry takes some 200 more than its text.
_CACHED_BYTES = 24_000_000
_ENTRY_BYTES = 200
_CACHED_LENGTH = 64
#: Characters of text that are encoded at a time.
_SLICE_CHARS = 1_000_000
_coders: dict[tuple, tuple] = {}
_tables: dict[str, list[bytes]] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _coder(ranks_path: str, pattern: str) -> tuple:
    """Splitter, encoder of one match, and this worker's cache."""
    key = ranks_path, pattern
    if key not in _coders:
        import regex
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        _coders[key] = regex.compile(pattern), encoding._encode_single_piece, {}
    return _coders[key]


def _table(ranks_path: str) -> list[bytes]:
    """The bytes of each rank."""
    if ranks_path not in _tables:
        ranks = read_ranks(ranks_path)
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _tables[ranks_path] = table
    return _tables[ranks_path]


def decode_ids(ids: bytes, ranks_path: str) -> bytes:
    return b"".join(map(_table(ranks_path).__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_text(text: str, ranks_path: str, pattern: str) -> bytes:
    """Ids of a text as little-endian 32-bit integers."""
    splitter, encode, cache = _coder(ranks_path, pattern)
    if len(cache) * _ENTRY_BYTES > _CACHED_BYTES:
        cache.clear()
    pieces = splitter.findall(text)
    missing = set(pieces).difference(cache)
    for piece in missing:
        cache[piece] = np.asarray(encode(piece), "<u4").tobytes()
    ids = b"".join(map(cache.__getitem__, pieces))
    for piece in missing:
        if len(piece) > _CACHED_LENGTH:
            del cache[piece]
    return ids


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with their texts, cut by the amount of text."""
    start, held, chars = 0, [], 0
    for text in batch.column("text"):
        held.append(text.as_py())
        chars += len(held[-1])
        if chars >= _SLICE_CHARS:
            yield batch.slice(start, len(held)), held
            start, held, chars = start + len(held), [], 0
    if held:
        yield batch.slice(start, len(held)), held


def _digested(ids: list[bytes], ranks_path: str) -> list[pa.Array]:
    def sha(parts) -> pa.Array:
        return pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())

    counts = pa.array([len(x) // 4 for x in ids], pa.int64())
    return [counts, sha(ids), sha(decode_ids(x, ranks_path) for x in ids)]


_DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _encode_rows(rows: DataFrame, ranks_path: str, pattern: str, digest: bool = False) -> DataFrame:
    """Replace column ``text`` by ``ids``, or by the digests of ids and decoded bytes."""
    kept = [c for c in rows.columns if c != "text"]
    made = _DIGESTS if digest else "ids binary"
    names = [*kept, *[c.split()[0] for c in made.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(batch):
                ids = [encode_text(t, ranks_path, pattern) for t in texts]
                new = _digested(ids, ranks_path) if digest else [pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *new], names=names)

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, f"{types}, {made}")


def chunk_seams(chunk: str, start: int, core: int, last: bool, pattern) -> tuple[list[int], list[int]]:
    """Places in the text at which this chunk could be cut: in its first overlap and in its last.

    ``start`` is the chunk's place in the text, ``core`` the length up to the next
    chunk's start; what follows the core is shared with the next chunk.
    """
    limit = len(chunk) if last else len(chunk) - LOOK_AHEAD
    head, tail = [], []
    for match in pattern.finditer(chunk):
        at = match.end()
        if at > limit:
            break
        if not chunk[at - 1].isspace():
            if start and at <= len(chunk) - core:
                head.append(start + at)
            if not last and at > core:
                tail.append(start + at)
    return head, tail


def stitch(seams: list[tuple[int, list[int], list[int]]]) -> list[int]:
    """Cuts where neighbouring chunks have a boundary in common.

    A chunk's boundaries count from its own first agreed place on; without one, the
    chunk before goes on, and nothing is cut until chunks agree again.
    """
    cuts: list[int] = []
    trusted, floor = True, 0
    for (_, _, tail), (_, head, _) in zip(seams, seams[1:]):
        common = sorted(set(tail).intersection(head)) if trusted else []
        common = [c for c in common if c > floor]
        if common:
            cuts.append(common[0])
            floor = common[0]
        trusted = bool(common)
    return cuts


def _long_ids(texts: DataFrame, ranks_path: str, pattern: str, chunk: int, overlap: int, digest: bool) -> DataFrame:
    """(key, ids), or (key, digests), of distinct long texts (key, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                for n, start in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([key], pa.binary()), "n": pa.array([n], pa.int64()),
                        "start": pa.array([start], pa.int64()), "last": [start + chunk >= len(text)],
                        "text": [text[start : start + chunk + overlap]],
                    })

    def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _coder(ranks_path, pattern)[0]
        for batch in batches:
            for row in batch.to_pylist():
                head, tail = chunk_seams(row["text"], row["start"], chunk, row["last"], splitter)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([row["key"]], pa.binary()), "n": pa.array([row["n"]], pa.int64()),
                    "head": pa.array([head], pa.list_(pa.int64())), "tail": pa.array([tail], pa.list_(pa.int64())),
                })

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = sorted((s["n"], s["head"], s["tail"]) for s in row["seams"])
                edges = [0, *stitch(found), len(row["text"])]
                for n, (a, b) in enumerate(zip(edges, edges[1:])):
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([row["key"]], pa.binary()), "n": pa.array([n], pa.int64()), "text": [row["text"][a:b]],
                    })

    chunks = texts.mapInArrow(cut, "key binary, n bigint, start bigint, last boolean, text string").repartition("key", "n")
    found = chunks.mapInArrow(seams, "key binary, n bigint, head array<bigint>, tail array<bigint>")
    # one row per long text: the boundaries in its overlaps
    gathered = found.groupBy("key").agg(F.collect_list(F.struct("n", "head", "tail")).alias("seams"))
    parts = texts.join(gathered, "key").mapInArrow(pieces, "key binary, n bigint, text string").repartition("key", "n")
    coded = _encode_rows(parts, ranks_path, pattern)
    made = _DIGESTS if digest else "ids binary"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                found = sorted((p["n"], p["ids"]) for p in row.column("pieces")[0].as_py())
                ids = [b"".join(part for _, part in found)]
                new = _digested(ids, ranks_path) if digest else [pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([row.column("key"), *new], names=["key", *[c.split()[0] for c in made.split(", ")]])

    # one row per long text
    return coded.groupBy("key").agg(F.collect_list(F.struct("n", "ids")).alias("pieces")).mapInArrow(whole, f"key binary, {made}")


def _coded(docs: DataFrame, ranks_path: str, pattern: str, key: str, chunk: int, overlap: int, digest: bool) -> DataFrame:
    rows = docs.select(F.col(key), whole_text().alias("text"))
    short = _encode_rows(rows.filter(F.length("text") <= chunk), ranks_path, pattern, digest)
    long_rows = rows.filter(F.length("text") > chunk).select(F.col(key).alias("row_id"), text_key().alias("key"), "text")
    found = _long_ids(long_rows.select("key", "text").dropDuplicates(["key"]), ranks_path, pattern, chunk, overlap, digest)
    made = [c for c in found.columns if c != "key"]
    coded = long_rows.select("row_id", "key").join(found, "key").select(F.col("row_id").alias(key), *made)
    return short.unionByName(coded)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id",
    chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """(key, ids) of every row; ids are little-endian 32-bit integers in one binary value."""
    return _coded(docs, ranks_path, pattern, key, chunk, overlap, False)


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id",
    chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again."""
    return _coded(docs, ranks_path, pattern, key, chunk, overlap, True)


def decode(coded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded) from coded rows; the decoded bytes as one binary value."""
    kind = coded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                back = pa.array([decode_ids(x, ranks_path) for x in part.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(key), back], names=[key, "decoded"])

    return coded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, decoded binary")


def digests(coded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) from coded rows."""
    kind = coded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *_digested(part.column("ids").to_pylist(), ranks_path)],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return coded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, {_DIGESTS}")
