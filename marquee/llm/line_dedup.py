"""Fuzzy line deduplication over the whole corpus.

Lines are normalised to their lower-case words of letters and digits. Equal normalised
lines are one from the start. Other lines get a SimHash in blocks: a hash deals the words of
a line over more classes than it has words, and classes join their neighbours until their words
tell enough: the logarithm of the number of lines but for a few bits, where a word of one in 2^k
lines tells k bits. The words of such a class have a 64-bit SimHash of their own. Edits reach some
classes only; by the pigeonhole principle, with fewer classes reached than there are the others keep
their block, and lines that share a block are candidates. So unlike lines share as few blocks in a
large corpus as in a small one. Short lines are dealt by their runs of three
characters instead, twice, so that one mistyped letter leaves most classes alone. The second, third, ...
equal word or run of a line is a feature of its own, so that a frequent word does not outvote the
rest of a class. As a line has more
classes the longer it is, the chance to share one does not fall with the length.

Candidates whose SimHashes over all words differ in few enough bits, and which their
runs of three characters do not rule out, are verified by edit similarity of the normalised lines (at least 0.9), and of each connected group only the first
occurrence, in the order of document id and line, stays.

Words here are also the single characters of scripts without spaces, such as ideographs, kana
and Thai; edit similarity is taken on the line as it is.

Defined cases: of lines of fewer than two words only equal ones go, and these only with
``least_words`` 1; a line without words is never removed; a null text stays null;
a null id comes after all others; rows equal in id and text are one document here, so
both lose or keep the same lines; a document may end up with an empty text.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import may_contain, whole_text
from marquee.llm.linking import linked_by_sketch, sharing
from marquee.operators.lineage import emptied, shuffles_removed, stored

#: Fuzzy lines have so many words at least.
MIN_WORDS = 2
#: 70 % of words in common: 64 * acos(0.7) / pi = 16 bits differ, and twice the deviation of 3.5 more.
DISTANCE = 24
#: So many SimHashes, in which rare words weigh more, are compared at that distance each; or one in which all weigh the same at the other.
_SKETCHES, _EVEN_DISTANCE = 3, 16
#: Words that are more than one in so many lines are frequent; others weigh as much as several of these.
_FREQUENT, _RARE_WEIGHT = 20, 4
#: For words and for runs of characters: a block may be shared by two to the power of so many unlike lines, and so many times a line is dealt.
_SPARE = (5, 1), (6, 2)
SIMILARITY = 0.9
#: Lines of fewer characters are dealt by runs of three characters, others by words; those close to it by both.
SHORT_LINE = 96

#: ASCII other than letters, digits and line feed, Latin-1 signs, general and ideographic punctuation. The former are listed
#: one by one, as a set of single signs takes one step to test and each range another.
_LISTED = "".join(f"\\x{c:02X}" for a, b in ((0x00, 0x09), (0x0B, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0xBF)) for c in range(a, b + 1))
_BREAK = f"[{_LISTED}\u2000-\u206F\u3000-\u303F]+"


#: Scripts written without spaces: Thai to Burmese, Khmer, ideographs and kana.
_UNSPACED = r"[\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
_HIGH = r"[\x{E00}-\x{3FFFF}]"


def plain_lines(text: Column) -> Column:
    """The normalised lines of a text, with a blank more at either end where a line has other signs there."""
    return F.split(F.regexp_replace(F.lower(text), _BREAK, " "), "\n")


def _units(plain: Column) -> Column:
    """The words of a line, with characters of scripts without spaces as words of their own."""
    apart = F.array_remove(F.split(F.regexp_replace(plain, f"({_UNSPACED})", " $1 "), " +"), "")
    # each of these characters takes three bytes and more
    some = (F.octet_length(plain) > F.length(plain) + 1) & plain.rlike(_HIGH) & plain.rlike(_UNSPACED)
    return F.when(some, apart).otherwise(F.split(plain, " "))


def _grams(plain: Column) -> Column:
    """The runs of three characters of a short line, its ends included."""
    ended = F.concat(F.lit(" "), plain, F.lit(" "))
    starts = F.sequence(F.lit(1), F.length(plain))
    return F.when(F.length(plain) < SHORT_LINE, F.transform(starts, lambda i: F.substr(ended, i, F.lit(3)))).otherwise(F.array())


#: A line of fewer characters has fewer than 2**14 words, single characters counted.
_LONG_LINE = 2**14 - 1

#: Numbers that make the sketches different hashes of the same words.
_SALTS = [0x9E3779B97F4A7C15 * i % 2**64 for i in range(1, _SKETCHES + 1)]
_SKETCH = [f"sketch{i}" for i in range(_SKETCHES)]

_WIDTH = 16
_LANES = np.uint64(sum(1 << (_WIDTH * j) for j in range(64 // _WIDTH)))
#: Four counts share a number as long as they stay below this.
_LANE_COUNT = 2 ** (_WIDTH - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """One to one on 64-bit numbers; every bit depends on all bits."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _majority(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """The SimHash of each run of hashes: a bit is set if more than half of them, or of their weights, have it.

    Adding 2^14 - half - 1 to a count sets bit 14 if the count is above half; this is done for
    four counts in one number at once.
    """
    bits = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return bits
    weighed = sizes if weights is None else np.add.reduceat(weights, starts).astype(np.int64)
    lift = (2 ** (_WIDTH - 2) - 1 - weighed // 2).astype(np.int64).view(np.uint64) * _LANES
    for k in range(_WIDTH):
        held = (hashes >> np.uint64(k)) & _LANES
        counts = np.add.reduceat(held if weights is None else held * weights, starts)
        bits |= (((counts + lift) >> np.uint64(_WIDTH - 2)) & _LANES) << np.uint64(k)
    for i in np.flatnonzero(weighed >= _LANE_COUNT):
        at = slice(starts[i], starts[i] + sizes[i])
        each = np.uint64(1) if weights is None else weights[at]
        bits[i] = sum(1 << b for b in range(64) if 2 * int((((hashes[at] >> np.uint64(b)) & np.uint64(1)) * each).sum()) > weighed[i])
    return bits


def _small_majority(hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same as ``_majority`` where most runs have four hashes at most."""
    bits = np.empty(len(starts), np.uint64)
    for size in (1, 2, 3, 4):
        at = np.flatnonzero(sizes == size)
        a, *more = (hashes[starts[at] + i] for i in range(size))
        if size < 3:
            bits[at] = a & more[0] if more else a
        elif size == 3:
            bits[at] = a & more[0] | more[1] & (a | more[0])
        else:
            b, c, d = more
            bits[at] = a & b & (c | d) | c & d & (a | b)
    at = np.flatnonzero(sizes > 4)
    held = sizes[at]
    ends = np.cumsum(held)
    places = np.repeat(starts[at] - (ends - held), held) + np.arange(ends[-1] if len(ends) else 0)
    bits[at] = _majority(hashes[places], ends - held, held)
    return bits


def _classes(size: np.ndarray) -> np.ndarray:
    """The power of two that leaves two to four of ``size`` features to a class on average."""
    return 1 << (np.frexp(np.maximum(size // 2, 1))[1].astype(np.int64) - 1)


def _occurrences(line: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes of features, of which the second, third, ... equal one of a line has a hash of its own.

    Otherwise a class with a frequent word several times would have that word's hash, whatever else is in it.
    """
    key = (line.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16))
    order = np.argsort(key)
    key = key[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    at = np.arange(len(key))
    nth = np.empty(len(key), np.uint64)
    nth[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return np.where(nth == 0, hashes, _mixed(hashes + nth * np.uint64(0x9E3779B97F4A7C15)))


@dataclass
class Rarity:
    """What features tell, in sixteenths of a bit: ``told`` for the frequent ones, whose ``hashes`` are in rising order, ``others`` for the rest.

    A block tells ``needed`` at least; lines are dealt ``dealings`` times, at first over a number of classes
    that follows their features times ``spread``.
    """

    hashes: np.ndarray
    told: np.ndarray
    others: int
    needed: int
    spread: int
    dealings: int

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), self.others, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.told[at], self.others)


#: Without counts: a block has two features.
_UNCOUNTED = Rarity(np.empty(0, np.uint64), np.empty(0, np.int64), others=1, needed=2, spread=1, dealings=1)


def _blocks(line: np.ndarray, hashes: np.ndarray, size: np.ndarray, kind: int, told: np.ndarray, rarity: Rarity) -> tuple[np.ndarray, np.ndarray]:
    """(line, block) of the classes that tell enough; ``size`` tells the features of each line, ``told`` what each of them tells.

    A class that tells too little joins its neighbour, if that one tells too little as well, and so on by halves of the number of
    classes; what is left at last is a block only of a line without any other. A line whose size is close to a step in
    the number of classes is dealt by both numbers, so that similar lines always have one in common.
    """
    sized = size * rarity.spread
    high, low = _classes(sized), _classes(np.floor(sized * SIMILARITY).astype(np.int64))
    owners, blocks = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for dealing in range(rarity.dealings):
        for number, dealt in ((high, np.ones(len(size), bool)), (low, low != high)):
            dealt = dealt[line]
            of, hash_, bits = line[dealt], hashes[dealt], told[dealt]
            many = number[of].astype(np.uint64)
            # the bits of the hash that choose the class are mixed anew, as all features of a class share them
            no = (_mixed(hash_ ^ (many * np.uint64(0xD1B54A32D192ED03) + np.uint64(dealing))) & (many - np.uint64(1))).astype(np.int64)
            before = np.cumsum(number) - number
            order = np.argsort(before[of] + no)
            of, hash_, bits, no = of[order], hash_[order], bits[order], no[order]
            width, some = number[of], np.zeros(len(size), bool)
            while len(of):
                cell = before[of] + no
                starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                sizes = np.diff(np.append(starts, len(cell)))
                owner, left = of[starts], width[starts]
                full = (np.add.reduceat(bits, starts) >= rarity.needed) & (sizes > 1)
                some[owner[full]] = True
                full |= (left == 1) & (sizes > 1) & ~some[owner]
                name = _mixed(number[owner[full]].astype(np.uint64) * np.uint64(16) + np.uint64(2 * dealing + kind))
                name = _mixed(name + left[full].astype(np.uint64)) + no[starts[full]].astype(np.uint64)
                owners.append(owner[full])
                blocks.append(_mixed(_small_majority(hash_, starts[full], sizes[full]) ^ _mixed(name)))
                rest = ~np.repeat(full, sizes) & (width > 1)
                of, hash_, bits, no, width = of[rest], hash_[rest], bits[rest], no[rest] >> 1, width[rest] >> 1
    return np.concatenate(owners), np.concatenate(blocks)


def _signed(batch: pa.RecordBatch, keys: list[str], frequent: np.ndarray, whole: bool, rarities: Sequence[Rarity]) -> pa.RecordBatch:
    """The key columns of a batch with words, hash, mark, sketches and blocks of its lines."""
    rows = batch.num_rows
    dealt = batch.column("_dealt").to_numpy(zero_copy_only=False)
    owners, blocks = [], []
    for kind, column in enumerate(("_words", "_grams")):
        lists = batch.column(column)
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        line = np.repeat(np.arange(rows), size)
        if column == "_words":
            words, some = size, np.flatnonzero(size)
            signature = np.zeros(rows, np.uint64)
            starts = (np.cumsum(size) - size)[some]
            if whole:
                signature[some] = _majority(hashes, starts, size[some])
            mark = np.zeros(rows, np.uint64)
            features = _occurrences(line, hashes) if len(line) else hashes
            mark[some] = _majority(features, starts, size[some])
            often = np.append(frequent, frequent[-1:])[np.searchsorted(frequent, hashes)] == hashes if len(frequent) else False
            weights = np.where(often, 1, np.full(len(hashes), _RARE_WEIGHT)).astype(np.uint64)
            sketches = np.zeros((_SKETCHES, rows), np.uint64)
            for i in range(_SKETCHES):
                sketches[i, some] = _majority(_mixed(features + np.uint64(_SALTS[i])), starts, size[some], weights)
            chosen = dealt[line]
            line, features, hashes = line[chosen], features[chosen], hashes[chosen]
        elif len(line):
            features = _occurrences(line, hashes)
        if len(line):
            found = _blocks(line, features, size, kind, rarities[kind].of(hashes), rarities[kind])
            owners.append(found[0])
            blocks.append(found[1])
    owner = np.concatenate([np.empty(0, np.int64), *owners])
    block = np.concatenate([np.empty(0, np.uint64), *blocks])[np.argsort(owner, kind="stable")]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(block.view(np.int64)))
    numbers = [pa.array(words), pa.array(signature.view(np.int64)), pa.array(mark.view(np.int64))]
    numbers += [pa.array(x.view(np.int64)) for x in sketches]
    return pa.RecordBatch.from_arrays([*[batch.column(k) for k in keys], *numbers, lists], names=[*keys, "words", "hash", "mark", *_SKETCH, "blocks"])


def with_signatures(
    lines: DataFrame, keys: list[str], plain: str, frequent: Sequence[int] = (), whole: bool = True, rarities: Sequence[Rarity] = (_UNCOUNTED, _UNCOUNTED)
) -> DataFrame:
    """(keys, words, hash, mark, sketch0, sketch1, ..., blocks) of lines; ``keys`` are columns of it that go along.

    ``hash`` is the SimHash over all words (0 without ``whole``), ``mark`` the one in which equal words of a line count as different features,
    and so they do in the sketches, where words whose hashes are not in ``frequent`` weigh more. ``rarities`` are those of words and of
    runs of characters, which travel as hashes; a batch of lines is signed at once.
    """
    hashed = [F.transform(f(F.col(plain)), lambda x: F.xxhash64(x)).alias(n) for n, f in (("_words", _units), ("_grams", _grams))]
    sized = lines.select(*keys, *hashed, (F.length(plain) >= SHORT_LINE * SIMILARITY).alias("_dealt"))
    schema = T.StructType(lines.select(*keys).schema.fields)
    for column in ("words", "hash", "mark", *_SKETCH):
        schema = schema.add(column, "long")
    schema = schema.add("blocks", T.ArrayType(T.LongType()))
    held = np.sort(np.array(frequent, np.int64).view(np.uint64))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _signed(batch, keys, held, whole, rarities)

    return sized.mapInArrow(sign, schema)


def _counts(lines: DataFrame, features: Callable[[Column], Column], least: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the features that lines have more than ``least`` times: so many divided by ``least`` at most."""
    hashes = lines.select(F.explode(features(F.col("plain"))).alias("feature")).select(F.xxhash64("feature").alias("hash"))
    rows = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least).collect()
    return np.array([r["hash"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def _frequent_words(lines: DataFrame) -> list[int]:
    """The hashes of words that are more than one in ``_FREQUENT`` lines."""
    return _counts(lines, _units, lines.count() / _FREQUENT)[0].tolist()


def _rarities(lines: DataFrame) -> tuple[list[int], list[Rarity]]:
    """The hashes of frequent words, and the rarity of words and of runs of characters.

    A feature of one in 2^k lines tells k bits. As a block tells the logarithm of the number of lines, but for ``_SPARE`` bits, a line has so
    many blocks with 2^``_SPARE`` unlike lines each, whatever that number is. Features that tell half of what a block needs are not
    counted one by one, so the counts kept grow as the root of the number of lines.
    """
    out, often = [], []
    for features, part, spare, dealings in ((_units, lines, *_SPARE[0]), (_grams, lines.filter(F.length("plain") < SHORT_LINE), *_SPARE[1])):
        total = max(part.count(), 1)
        needed = max(np.log2(total) - spare, 2.0)
        hashes, counts = _counts(part, features, total / max(2 ** (needed / 2), _FREQUENT))
        if not out:
            often = hashes[counts * _FREQUENT > total].tolist()
        order = np.argsort(hashes.view(np.uint64))
        told = np.maximum(np.floor(-16 * np.log2(np.minimum(counts[order] / total, 1))), 0).astype(np.int64)
        others = int(np.ceil(8 * needed))
        out.append(Rarity(hashes.view(np.uint64)[order], np.minimum(told, others), others, int(16 * needed), spread=4, dealings=dealings))
    return often, out


def _text_id() -> Column:
    return F.xxhash64(whole_text())


def _position() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_id", "line_no")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", _text_id().alias("text_id"), whole_text().alias("text"))


def _split(texts: DataFrame) -> DataFrame:
    """(doc_id, text_id, line_no, plain) of every line; plain is the normalised line."""
    lines = texts.select("doc_id", "text_id", F.posexplode_outer(plain_lines(F.col("text"))).alias("line_no", "plain"))
    return lines.withColumn("plain", F.trim("plain"))


def _keyed(texts: DataFrame) -> DataFrame:
    """(doc_id, text_id, line_no, line_key, plain) of every line with words."""
    return _split(texts).filter("plain != ''").withColumn("line_key", F.unhex(F.md5("plain")))


def _merged_lines(docs: DataFrame) -> DataFrame:
    """(line_key, first, copies, chars, plain) of distinct normalised lines with words.

    Equal lines merge inside each task, then in the one shuffle that carries lines.
    """
    one = _keyed(_texts(docs)).groupBy("line_key").agg(
        F.min(_position()).alias("first"), F.count(F.lit(1)).alias("copies"), F.min("plain").alias("plain")
    )
    return one.select("line_key", "first", "copies", F.length("plain").alias("chars"), "plain")


def _distinct_lines(docs: DataFrame, least_words: int = MIN_WORDS) -> DataFrame:
    """Distinct normalised lines with enough words, and their signatures."""
    return with_signatures(_merged_lines(docs), ["line_key", "first", "copies", "chars"], "plain").filter(F.col("words") >= least_words)


def _unlike(words: Column, other: Column) -> Column:
    """Number of words up to the first that differs from ``other``, or that one of both lacks."""
    same = F.zip_with(words, other, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(words)).cast("int")


def _rest(words: Column, start: Column) -> Column:
    return F.slice(words, start + 1, F.size(words))


def _within(a: str, b: str, most: int) -> bool:
    """Whether at most so many edits make one text the other.

    Column by column of the table of edit distances, where two long integers hold the cells that are one
    more and one less than the cell above (Myers 1999).
    """
    a, b = (a, b) if len(a) > len(b) else (b, a)
    if len(a) - len(b) > most or len(a) <= most:
        return len(a) <= most
    at: dict[str, int] = {}
    for i, sign in enumerate(a):
        at[sign] = at.get(sign, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) >> 1
    more, less, edits = full, 0, len(a)
    for left, sign in zip(range(len(b) - 1, -1, -1), b):
        same = at.get(sign, 0)
        across = (((same & more) + more) ^ more) | same
        up, down = less | full & ~(across | more), more & across
        edits += 1 if up & last else -1 if down & last else 0
        if edits - left > most:
            return False
        up, here = up << 1 | 1, same | less
        more, less = (down << 1 | full & ~(here | up)) & full, up & here
    return edits <= most


def similar(pairs: DataFrame, name: str = "") -> DataFrame:
    """The rows whose word lists ``wa`` and ``wb``, joined by blanks, have an edit similarity of 0.9.

    What both lines begin or end with adds nothing to their edit distance, so it is taken
    off before; each word keeps the blank after it. Nothing is stored, so ``name`` has no effect.
    """

    def ahead(df: DataFrame) -> DataFrame:
        cut = df.withColumn("_n", _unlike(F.col("wa"), F.col("wb")))
        cut = cut.withColumns({"wa": F.reverse(_rest(F.col("wa"), F.col("_n"))), "wb": F.reverse(_rest(F.col("wb"), F.col("_n")))})
        return cut.drop("_n")

    def joined(words: str) -> Column:
        return F.array_join(F.transform(words, lambda w: F.concat(w, F.lit(" "))), "")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([_within(*p) for p in zip(*(batch.column(c).to_pylist() for c in ("_la", "_lb", "_most")))], pa.bool_()))

    chars = F.greatest(*[F.length(F.array_join(w, " ")) for w in ("wa", "wb")])
    sized = pairs.withColumn("_most", _most_edits(chars))
    middles = ahead(ahead(sized)).withColumns({"_la": joined("wa"), "_lb": joined("wb")}).drop("wa", "wb")
    return middles.mapInArrow(near, middles.schema).drop("_la", "_lb", "_most")


def _most_edits(chars: Column) -> Column:
    return F.floor(chars * (1 - SIMILARITY) + 1e-9).cast("int")


_GRAM = 3
#: So many pairs are compared by their runs of characters at once.
_PAIRS = 512
#: The blocks are joined in so many parts, one after the other.
_PARTS = 4
#: The fewest and the most classes of a profile.
_FEWEST, _MOST = 64, 8192


def _runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of all runs of three characters of some lines."""
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy(zero_copy_only=False))
    # a code point takes 21 bits
    run = (points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:]
    whole = owner[:-2] == owner[2:]
    return owner[:-2][whole], _mixed(run[whole])


def _with_profiles(lines: DataFrame) -> DataFrame:
    """(id, plain, profile): how many runs of three characters of a line fall into each of its classes, a byte each.

    There are as many classes as the next power of two above the length, so that those of a shorter line are unions of those of a longer.
    """

    def profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, run = _runs(batch.column("plain"))
            size = pc.utf8_length(batch.column("plain")).to_numpy(zero_copy_only=False).astype(np.int64)
            size = np.minimum(2 ** np.frexp(np.maximum(size, _FEWEST - 1))[1].astype(np.int64), _MOST)
            ends = np.cumsum(size)
            at = (ends - size)[owner] + (run.view(np.int64) & (size[owner] - 1))
            held = np.minimum(np.bincount(at, minlength=ends[-1] if len(ends) else 0), 255).astype(np.uint8).tobytes()
            profile = pa.array([held[end - n : end] for n, end in zip(size, ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("plain"), profile], names=["id", "plain", "profile"])

    return lines.select("id", "plain").mapInArrow(profiles, "id long, plain string, profile binary")


def _profiles_apart(batch: pa.RecordBatch) -> np.ndarray:
    """For each pair of lines how far their profiles are apart, by the classes of the shorter line."""
    held = [batch.column(c).to_pylist() for c in ("fa", "fb")]
    least = np.array([min(len(x), len(y)) for x, y in zip(*held)], np.int64)
    apart = np.zeros(len(least), np.int64)
    for size in np.unique(least):
        rows = np.flatnonzero(least == size)
        x, y = (np.stack([np.frombuffer(f[i], np.uint8).reshape(-1, size).sum(axis=0, dtype=np.int32) for i in rows]) for f in held)
        apart[rows] = np.abs(x - y).sum(axis=1)
    return apart


def _grams_apart(batch: pa.RecordBatch) -> np.ndarray:
    """For each pair of lines in how many runs of three characters they differ, as multisets."""
    (x, u), (y, v) = _runs(batch.column("ta")), _runs(batch.column("tb"))
    # batches are short, so a pair's number and most of a hash go into one number
    key = np.concatenate([x, y]).astype(np.uint64) << np.uint64(48) | (np.concatenate([u, v]) >> np.uint64(16))
    if not len(key):
        return np.zeros(batch.num_rows, np.int64)
    order = np.argsort(key)
    key, sign = key[order], np.repeat([1, -1], [len(x), len(y)])[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    apart = np.abs(np.add.reduceat(sign, starts))
    return np.bincount((key[starts] >> np.uint64(48)).astype(np.int64), weights=apart, minlength=batch.num_rows)


def _runs_allow(pairs: DataFrame, apart: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of pairs, with ``chars`` of the longer line, that runs of three characters do not rule out.

    An edit takes away three runs and adds three at most; runs that count as equal only bring lines closer.
    """

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _PAIRS):
                batch = whole.slice(at, _PAIRS)
                most = np.floor(batch.column("chars").to_numpy() * (1 - SIMILARITY) + 1e-9)
                yield batch.filter(pa.array(apart(batch) <= 2 * _GRAM * most))

    return pairs.mapInArrow(allowed, pairs.schema)


def _may_link(x: Column, y: Column) -> Column:
    """Whether two lines are of nearly one length and have near SimHashes."""

    def apart(*columns: str) -> Column:
        return reduce(operator.add, [F.bit_count(x[c].bitwiseXOR(y[c])) for c in columns])

    longer = F.greatest(x["chars"], y["chars"])
    near = (apart(*_SKETCH) <= _SKETCHES * DISTANCE) | (apart("mark") <= _EVEN_DISTANCE) | (longer >= _LONG_LINE)
    return near & (F.least(x["chars"], y["chars"]) >= longer * SIMILARITY - 1e-9)


def dropped_lines(docs: DataFrame, name: str = "lines", least_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, drop): numbers from 0 of the lines that go, for documents that lose any.

    A distinct line is known by its number in the stored table, which is short and ascends in each
    file, so that rows of blocks and pairs stay small. Lines are stored once, so that pairs need not
    shuffle them again to be verified.
    """
    lines = stored(_merged_lines(docs).withColumn("id", F.monotonically_increasing_id()), name, "zstd")
    frequent, rarities = _rarities(lines)
    signed = stored(with_signatures(lines, ["id", "chars"], "plain", frequent, False, rarities).drop("hash"), name)
    members = signed.filter(F.col("words") >= MIN_WORDS).select(F.explode("blocks").alias("bucket"), "id")
    live = [stored(sharing(members.filter(F.pmod("bucket", F.lit(_PARTS)) == n)), name) for n in range(_PARTS)]
    sketches = stored(signed.select("id", "words", F.struct("mark", "chars", *_SKETCH).alias("p")), name)
    emptied(signed)

    def confirm(pairs: DataFrame) -> DataFrame:
        wanted = may_contain(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id")
        x, y = (lines.filter(wanted(F.col("id"))).select(F.col("id").alias(i), F.col("plain").alias(f"t{i}")) for i in "ab")
        both = pairs.join(x, "a").join(y, "b").withColumn("chars", F.greatest(F.length("ta"), F.length("tb")))
        # lines travel as texts: lists of their words take several times the space
        both = _runs_allow(both.select("a", "b", "ta", "tb", "chars"), _grams_apart)
        return similar(both.select("a", "b", F.split("ta", " ").alias("wa"), F.split("tb", " ").alias("wb"))).select("a", "b")

    groups = linked_by_sketch(live, sketches.select("id", "p"), _may_link, confirm, name)
    distinct = lines.drop("plain", "chars").join(sketches.filter(F.col("words") >= least_words).select("id"), "id")
    rooted = distinct.join(groups, "id", "left").filter("copies > 1 OR root IS NOT NULL")
    rooted = rooted.select("line_key", "first", "copies", F.coalesce("root", "id").alias("root"))
    several = rooted.groupBy("root").agg(F.min("first").alias("keeper"), F.sum("copies").alias("n")).filter("n > 1")
    keepers = stored(rooted.join(several, "root").select("line_key", "keeper"), name)
    emptied(lines)
    emptied(sketches)
    places = _keyed(_texts(docs)).drop("plain").filter(may_contain(keepers, "line_key")(F.col("line_key")))
    gone = places.join(keepers, "line_key").filter(_position() != F.col("keeper"))
    return gone.groupBy("doc_id", "text_id").agg(F.collect_set("line_no").alias("drop"))


def dedup_lines(
    docs: DataFrame, name: str = "lines", least_words: int = MIN_WORDS, counted: str = "_lines", dropped: str = "_dropped"
) -> DataFrame:
    """The documents with their text rid of repeated lines, and the counts ``counted`` and ``dropped`` added.

    These two names must differ from the documents' own columns. Documents that lose nothing are not shuffled.
    """
    with shuffles_removed(docs.sparkSession):
        drops = stored(dropped_lines(docs, name, least_words).toDF("_doc_id", "_text_id", "_drop"), name)
    held = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text", _text_id().alias("_id"))
    touched = may_contain(drops, "_text_id")(F.col("_id"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_id") == F.col("_text_id"))
    changed = held.filter(touched).join(drops, same, "left")
    rest = held.filter(~touched).withColumn("_drop", F.lit(None).cast("array<int>"))
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(1), F.size(lines)), F.transform("_drop", lambda n: n + 1))
    text = F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda n: F.element_at(lines, n)), "\n"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    columns = [text.alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns]

    def cleaned(rows: DataFrame) -> DataFrame:
        return rows.select(
            *columns, count.cast("long").alias(counted), F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias(dropped)
        )

    return cleaned(changed).unionByName(cleaned(rest))
