"""Document fingerprints from closed syncmers.

A text is a sequence of units: runs of up to 24 characters without white space, and
single ideographs. Of all k-mers of units, those count whose smallest inner s-mer, by
hash, is the first or the last one. Whether a k-mer counts depends on nothing around it,
so an edit only touches the anchors it overlaps, and anchors of two texts can be matched
by position. The fingerprint lists the anchors' hashes in the order of the text; likeness
is the share of distinct anchors that two fingerprints have in common.

Defined cases: a text of fewer than k units is one anchor; in a longer one where no k-mer
counts (one of 7 to 10 units at most), all do, at most four; a null text counts as empty;
a text without units has no anchor, and is like another without any. Rows with equal ids
follow each other in the order of their texts' digests; null ids come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import text_key, whole_text
from marquee.operators.lineage import stored

K = 7
S = 2
_WIDE = r"฀-๿⺀-鿿가-힯"
UNIT = rf"[{_WIDE}]|[^\s{_WIDE}]{{1,24}}"

#: Segments of about equal row counts that the ids are cut into, and rows of a bucket.
SEGMENTS = 256
BUCKET_ROWS = 2_000


def unit_hashes(text: Column) -> Column:
    units = F.regexp_extract_all(F.lower(text), F.lit(UNIT), F.lit(0))
    return F.transform(units, lambda u: F.xxhash64(u))


def _inner(hashes: Column) -> Column:
    """Hashes of all s-mers."""
    count = F.size(hashes) - (S - 1)
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[hashes[i + j] for j in range(S)]))


def _anchors(row: DataFrame, hashes: str, inner: str) -> Column:
    """Places of the closed syncmers."""
    count = F.size(hashes) - (K - 1)
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    g, last = F.col(inner), K - S
    return F.filter(places, lambda i: F.least(g[i], g[i + last]) <= F.least(*[g[i + j] for j in range(1, last)]))


def with_anchors(df: DataFrame, text: str, places: str, fingerprint: str) -> DataFrame:
    """Add the places of a text's anchors, counted in units, and their hashes."""
    hashed = df.withColumn("_units", unit_hashes(F.col(text)))
    inner = hashed.withColumn("_inner", _inner(F.col("_units")))
    placed = inner.withColumn(places, F.when(F.size("_units").between(1, K - 1), F.array(F.lit(0))).otherwise(_anchors(inner, "_units", "_inner")))
    bare = (F.size(places) == 0) & (F.size("_units") >= K)
    placed = placed.withColumn(places, F.when(bare, F.sequence(F.lit(0), F.size("_units") - K)).otherwise(F.col(places)))
    hashes = F.transform(places, lambda i: F.hash(F.slice("_units", i + 1, F.lit(K))))
    return placed.withColumn(fingerprint, hashes).drop("_units", "_inner")


def likeness(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def _bucket(docs: DataFrame) -> Column:
    """A bucket number that rises with doc_id and holds about BUCKET_ROWS rows.

    Percentiles cut the ids in segments, whose limits are a bounded list; segments are
    cut evenly into as many buckets as their rows call for.
    """
    at = [i / SEGMENTS for i in range(1, SEGMENTS)]
    seen = docs.agg(F.count("doc_id").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.percentile_approx("doc_id", at, 10_000).alias("at")).first()
    if not seen["n"]:
        return F.lit(-1).cast("long")
    segments = max(1, min(SEGMENTS, seen["n"] // BUCKET_ROWS))
    step = SEGMENTS // segments
    limits = sorted({seen["low"], *seen["at"][step - 1 :: step]})
    parts = max(1, round(seen["n"] / len(limits) / BUCKET_ROWS))
    ends = [*limits[1:], seen["high"] + 1]
    doc_id = F.col("doc_id").cast("long")
    starts = F.array(*[F.lit(x).cast("long") for x in limits])
    widths = F.array(*[F.lit(max(1, -(-(high - low) // parts))).cast("long") for low, high in zip(limits, ends)])
    n = F.size(F.filter(starts, lambda x: x <= doc_id))
    inside = F.floor((doc_id - F.element_at(starts, n)) / F.element_at(widths, n)).cast("long")
    return F.when(doc_id.isNull(), F.lit(-1).cast("long")).otherwise((n - 1).cast("long") * (parts + 1) + inside)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form.

    The last third of a text is replaced by the beginning of the next document, in
    descending order of doc_id, and after the last one by that of the first. Rows are
    dealt to buckets of neighbouring ids; each bucket also gets the first row of the
    next one, so the next document is always in the same bucket, and a text is shuffled
    once.
    """
    rows = docs.select("doc_id", whole_text().alias("text"), text_key().alias("_key"))
    rows = rows.withColumn("_bucket", _bucket(docs))
    turned = F.bitwise_not(F.col("doc_id").cast("long"))
    rows = rows.withColumn("_place", F.struct(F.col("doc_id").isNull().alias("last"), turned.alias("turned"), F.col("_key").alias("key")))
    # one row per bucket from here
    firsts = stored(rows.groupBy("_bucket").agg(F.min(F.struct("_place", "text")).alias("first")), "firsts")
    down = Window.orderBy(F.desc("_bucket"))
    all_rows = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("_bucket").over(down), F.min("_bucket").over(all_rows))
    # the window over all buckets carries their numbers only
    order = firsts.select("_bucket").withColumn("_before", before)
    ends = firsts.join(order, "_bucket").select(F.col("_before").alias("_bucket"), "first")
    guests = ends.select(
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("first.text").alias("text"), "_bucket",
        F.struct(F.lit(True).alias("last"), F.lit(2**63 - 1).alias("turned"), F.unhex(F.lit("FF" * 17)).alias("key")).alias("_place"),
        F.lit(True).alias("_guest"),
    )
    own = rows.select("doc_id", "text", "_bucket", "_place", F.lit(False).alias("_guest"))
    marked = with_anchors(own.unionByName(guests), "text", "_places", "fingerprint").drop("_places")
    order = Window.partitionBy("_bucket").orderBy("_place", "_guest")
    following = F.lead(F.struct("text", "fingerprint")).over(order)
    paired = marked.repartition("_bucket").withColumn("_next", following).filter(~F.col("_guest"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - cut), F.substr(F.col("_next.text"), F.lit(1), cut))
    both = paired.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", F.col("_next.fingerprint").alias("_next"), edited.alias("_edited"))
    done = with_anchors(both, "_edited", "_places", "edited_fingerprint")
    return done.select(
        "doc_id", "n_chars", F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
