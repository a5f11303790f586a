"""Toxicity from character n-grams with naive Bayes log-count ratios.

Features are the character 3-, 4- and 5-grams of the lower-case text, present or not.
Each carries its log-count ratio between the two labels, and a logistic regression over
the scaled features gives the score. Counts, ratios and regression are fitted on at most
``FIT_ROWS`` labelled rows, those with the smallest hash of their id, so the sample does
not depend on row order. Of the n-grams in at least ``MIN_DOCUMENTS`` sampled texts, the
``FEATURES`` with the strongest evidence are kept: the model has a fixed size.

Whole texts are scored. Ids, language and source never enter a score.

Defined cases: null texts count as empty and get the score of a text without features;
null labels are not used; without rows of both labels the score is the smoothed share of
label 1; a null id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import whole_text
from marquee.operators.lineage import stored

GRAMS = (3, 4, 5)
FIT_ROWS = 12_000
MIN_DOCUMENTS = 5
FEATURES = 20_000
SMOOTHING = 1.0

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_FILTER_BITS = 22
_SLICE_CHARS = 1_000_000


def _gram_hashes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-gram: hashes at all places of the joined texts, and the texts' ends.

    A place is valid if the n-gram ends within its text.
    """
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    ends = np.cumsum([len(c) for c in codes], dtype=np.int64)
    chars = np.concatenate(codes).astype(np.uint64) if codes else np.empty(0, np.uint64)
    held = chars * _STEP
    size = 1
    for gram in GRAMS:
        while size < gram:
            held = held[:-1] if len(held) else held
            # an odd factor and a shift keep the order of the characters in the hash
            held = (held ^ (held >> np.uint64(29))) * _SPREAD + chars[size : size + len(held)] * _STEP
            size += 1
        yield held * _SPREAD + np.uint64(gram), ends


def _valid(places: np.ndarray, ends: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The text number of each place, and whether the n-gram ends in it."""
    owner = np.searchsorted(ends, places, side="right")
    return owner, places + gram <= ends[owner]


def text_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text number, feature) of all n-grams present, each once."""
    owners, features = [], []
    for (hashes, ends), gram in zip(_gram_hashes(texts), GRAMS):
        owner, valid = _valid(np.arange(len(hashes)), ends, gram)
        owners.append(owner[valid])
        features.append(hashes[valid])
    owner, feature = np.concatenate(owners), np.concatenate(features)
    order = np.lexsort((feature, owner))
    owner, feature = owner[order], feature[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])
    return owner[first], feature[first]


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= _SLICE_CHARS:
            yield part
            part, held = [], 0
    if part:
        yield part


@dataclass
class Vocabulary:
    """Selected features in rising order, with their ratios."""

    features: np.ndarray
    ratios: np.ndarray

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.features >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def __reduce__(self):
        return Vocabulary, (self.features, self.ratios)

    def present(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs (text number, feature number) in order."""
        pairs = []
        for (hashes, ends), gram in zip(_gram_hashes(texts), GRAMS):
            places = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            at = np.searchsorted(self.features, hashes[places])
            at[at == len(self.features)] = 0
            hit = self.features[at] == hashes[places] if len(self.features) else np.zeros(len(places), bool)
            places, at = places[hit], at[hit]
            owner, valid = _valid(places, ends, gram)
            pairs.append(owner[valid] * max(1, len(self.features)) + at[valid])
        found = np.unique(np.concatenate(pairs))
        return found // max(1, len(self.features)), found % max(1, len(self.features))


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        owner, feature = self.vocabulary.present(texts)
        total = np.bincount(owner, self.weights[feature] * self.vocabulary.ratios[feature], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int, name: str) -> DataFrame:
    """(text, y) of the labelled rows to learn from: ids whose crc32 leaves a rest by 5."""
    usable = labels.filter(F.col(label).isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    # at most ``rows`` rows, so they may be broadcast
    picked = usable.select("doc_id", F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    sample = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(picked), "doc_id").select("text", "y")
    return stored(sample.repartition(8), name)


def _counts(sample: DataFrame) -> DataFrame:
    """(feature, pos, neg): sampled texts of each label that have the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("y").to_numpy()
            done = 0
            for part in _slices(batch.column("text").to_pylist()):
                owner, feature = text_features(part)
                positive = labels[done + owner] == 1
                done += len(part)
                own, at = np.unique(feature, return_inverse=True)
                pos = np.bincount(at, positive, minlength=len(own)).astype(np.int64)
                neg = np.bincount(at, ~positive, minlength=len(own)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"feature": own.astype(np.int64), "pos": pos, "neg": neg})

    each = sample.mapInArrow(run, "feature bigint, pos bigint, neg bigint")
    return each.groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, name: str = "toxicity") -> Model:
    sample = training_rows(docs, labels, label, rows, name)
    seen = sample.agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")).first()
    if not seen["pos"] or not seen["neg"]:
        share = (seen["pos"] + 1) / (seen["pos"] + seen["neg"] + 2)
        empty = Vocabulary(np.empty(0, np.uint64), np.empty(0))
        return Model(empty, np.empty(0), float(np.log(share / (1 - share))))
    counts = stored(_counts(sample).filter(F.col("pos") + F.col("neg") >= MIN_DOCUMENTS), name)
    sums = counts.agg((F.sum("pos") + F.count("*") * SMOOTHING).alias("p"), (F.sum("neg") + F.count("*") * SMOOTHING).alias("q"))
    share = ((F.col("pos") + SMOOTHING) / F.col("p")) / ((F.col("neg") + SMOOTHING) / F.col("q"))
    rated = counts.join(F.broadcast(sums)).select("feature", F.log(share).alias("ratio"), (F.col("pos") + F.col("neg")).alias("n"))
    # at most FEATURES rows reach the driver
    best = rated.orderBy(F.desc(F.abs("ratio") * F.sqrt("n")), "feature").limit(FEATURES).collect()
    features = np.array([r["feature"] for r in best], np.int64).astype(np.uint64)
    order = np.argsort(features)
    vocabulary = Vocabulary(features[order], np.array([r["ratio"] for r in best])[order])

    @F.udf(VectorUDT())
    def scaled(text: str):
        at = vocabulary.present([text])[1]
        return Vectors.sparse(len(vocabulary.features), at.tolist(), vocabulary.ratios[at].tolist())

    # the rarer label weighs more, by the root of the ratio of the two counts
    weight = F.when(F.col("y") == 1, (seen["neg"] / seen["pos"]) ** 0.5).otherwise(1.0)
    ready = sample.select(F.col("y").cast("double").alias("label"), weight.alias("weight"), scaled("text").alias("features"))
    learner = LogisticRegression(weightCol="weight", maxIter=40, regParam=0.001, standardization=False, tol=1e-6)
    fitted = learner.fit(stored(ready, name))
    return Model(vocabulary, fitted.coefficients.toArray(), float(fitted.intercept))


def scorer(model: Model):
    """A function from a text column to scores between 0 and 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [model.score(part) for part in _slices(texts.tolist())]
        return pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = docs.select("doc_id", held_out().alias("held_out"), scorer(model)(whole_text()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is below one half, unchanged."""
    held = docs.select(F.struct(*docs.columns).alias("doc"), scorer(model)(whole_text()).alias("score"))
    return held.filter(F.col("score") < 0.5).select("doc.*")
