"""Token ids in Parquet list columns.

Documents are range-partitioned and sorted by id, encoded, and written by Spark's own
Parquet writer: ids in a dictionary-coded list column (a row group holds few distinct
ids, so they are packed in 16 bits), the sorted long columns delta-coded, row groups and
pages of a set size, each page with its bounds in the page index. A reader that wants
some documents or only the metadata opens only the pages it needs.

Encoding goes word by word: the vocabulary's normaliser and splitter never join
characters across ASCII white space, so the ids of a text are those of its words in a
row, and each worker encodes a word it has met before only once. A text that writes out a
special token goes to the library as a whole, which takes it for that token.

Defined cases: a null text is an empty one and has the end id alone; null ids sort first;
rows with equal ids stand in a stored order; an empty table gives a table without rows.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import whole_text

ROW_GROUP_BYTES = 32 * 1024 * 1024
PAGE_BYTES = 256 * 1024

_CACHED_WORDS = 400_000
_CACHED_LENGTH = 64
#: A Latin or Cyrillic letter, then an ASCII sign that begins no contraction; the dotted capital I is left out, as lowering parts it.
_MARKED = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}\x{400}-\x{481}\x{48A}-\x{52F}])([!-&(-/:-@\[-`{-~])"
_encoders: dict[str, tuple] = {}


def _encoder(vocabulary: str) -> tuple:
    """The tokenizer, its model, this worker's word cache, and the special tokens in lower case."""
    if vocabulary not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        literals = [t.content.lower().encode() for t in tokenizer.get_added_tokens_decoder().values()]
        _encoders[vocabulary] = tokenizer, tokenizer.model, {}, literals
    return _encoders[vocabulary]


def _byte_letters() -> dict[int, str]:
    """The letter by which the vocabulary's byte-level step shows each byte: itself if printable, else the next above 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in shown)
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + n) for n, b in enumerate(rest)}}


_LETTERS = _byte_letters()


def _encode_words(words: list[bytes], tokenizer, model) -> dict[bytes, bytes]:
    """Ids of single words.

    The splitter leaves a word of letters whole, so once normalised, the model takes it directly. Other words
    go through the library one by one.
    """
    out = {}
    ready = [(w, w.decode()) for w in words if w.isascii() and w.isalpha()]
    others = [w for w in words if not (w.isascii() and w.isalpha())]
    for start in range(0, len(others), 5_000):
        part = others[start : start + 5_000]
        texts = [w.decode("utf-8", "replace") for w in part]
        normal = tokenizer.normalizer.normalize_str(" ".join(texts)).split(" ")
        letters = [x.isalpha() for x in normal] if len(normal) == len(part) else [False] * len(part)
        ready += [(w, x.encode().decode("latin-1").translate(_LETTERS)) for w, x, one in zip(part, normal, letters) if one]
        rest = [n for n, one in enumerate(letters) if not one]
        found = tokenizer.encode_batch_fast([texts[n] for n in rest], add_special_tokens=False)
        out.update((part[n], np.asarray(e.ids, "<u4").tobytes()) for n, e in zip(rest, found))
    for word, text in ready:
        out[word] = array("I", [t.id for t in model.tokenize(text)]).tobytes()
    return out


def _gathered(parts: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``parts[c]`` for each code c in a row, and where each code's ids start in them."""
    sizes = np.fromiter((len(x) // 4 for x in parts), np.int64, len(parts))
    values = np.frombuffer(b"".join(parts), "<u4")
    taken = sizes[codes]
    starts = np.concatenate([[0], np.cumsum(taken)])
    first = (np.cumsum(sizes) - sizes)[codes] - starts[:-1]
    return values[np.repeat(first, taken) + np.arange(starts[-1])], starts


def encode_texts(texts: list[bytes], vocabulary: str) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers.

    Words are numbered by a dictionary of the slice, and the ids of a text are gathered by these numbers, so
    only distinct words are touched one by one. The normaliser composes characters, then lowers letters, so only
    words of ASCII alone may be lowered before it. A letter and a mark after it are never one token, so a blank
    between them changes no id.
    """
    tokenizer, model, cache, literals = _encoder(vocabulary)
    # a special token written out is one id wherever it stands, also inside a word
    whole = {n for n, text in enumerate(texts) if any(x in lowered for lowered in [text.lower()] for x in literals)}
    special = {n: np.asarray(tokenizer.encode(texts[n].decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes() for n in whole}
    # where all is ASCII, the lower case makes more words equal
    lowered = [b"" if n in whole else text.lower() if text.isascii() else text for n, text in enumerate(texts)]
    spread = pc.replace_substring_regex(pa.array(lowered, pa.binary()).view(pa.string()), _MARKED, r"\1 \2")
    parted = pc.ascii_split_whitespace(spread)
    numbered = parted.values.view(pa.binary()).dictionary_encode()
    codes, offsets = numbered.indices.to_numpy(), parted.offsets.to_numpy()
    # an empty text, and blanks around a text, give empty words, which have no ids
    words = [w.lower() if w.isascii() else w for w in numbered.dictionary.to_pylist()]
    if len(cache) > _CACHED_WORDS:
        cache.clear()
    missing = set(words).difference(cache)
    cache.update(_encode_words(list(missing), tokenizer, model))
    ids, starts = _gathered([cache[w] for w in words], codes)
    bounds = starts[offsets].tolist()
    found = [special[n] if n in special else ids[a:b].tobytes() for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
    for word in missing:
        if len(word) > _CACHED_LENGTH:
            del cache[word]
    return found


def _slices(texts: list[bytes], size: int = 4_000_000) -> Iterator[list[bytes]]:
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def encoded(rows: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Replace column ``text`` by n_tokens and token_ids; partitions and order stay."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            done = 0
            for part in _slices(texts):
                ids = [x + end for x in encode_texts(part, vocabulary)]
                counts = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                own = batch.slice(done, len(part))
                done += len(part)
                columns = [own.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), values)],
                    names=[*kept, "n_tokens", "token_ids"],
                )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, f"{types}, n_tokens bigint, token_ids array<int>")


def write_tokens(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 1,
    row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES,
) -> None:
    """Write (seq, doc_id, n_tokens, token_ids); ``seq`` rises in the order of doc_id."""
    rows = docs.select("doc_id", whole_text().alias("text"), F.xxhash64(whole_text()).alias("_tie"))
    # rows of one id are spread over tasks by their texts
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")
    table = encoded(ordered, vocabulary, end_id).select(F.monotonically_increasing_id().alias("seq"), "*")
    (
        table.write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary#seq", "false")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#n_tokens", "false")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("seq bigint, doc_id bigint, n_tokens bigint, token_ids array<int>").parquet(path)


def token_digests(tokens: DataFrame) -> DataFrame:
    """(seq, doc_id, n_tokens, ids_crc32) of stored tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            values = np.asarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
            offsets = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            counts = pa.array(np.diff(offsets).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("seq"), batch.column("doc_id"), counts, pa.array(sums, pa.int64())],
                names=["seq", "doc_id", "n_tokens", "ids_crc32"],
            )

    return tokens.select("seq", "doc_id", "token_ids").mapInArrow(run, "seq bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint")


def with_starts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``start``, the number of ids before a document.

    The upper bits of ``seq`` are the number of the written range. ``counts`` is the
    same table again, from which only the two count columns are read: one sum per range
    gives the offsets of the ranges.
    """
    part = F.shiftright("seq", 33).alias("part")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy(part).agg(F.sum("n_tokens").alias("sum"))
    offsets = sums.select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    return rows.select("*", part).join(offsets, "part").withColumn("start", start).drop("part", "offset")
