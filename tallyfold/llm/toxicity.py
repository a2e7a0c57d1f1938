"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are words, their stems (the first five bytes), pairs of neighbours and pairs with one word
between, hashed to ``2**bits`` buckets; a text has a feature or not, so its length doesn't matter. Each
coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero; the others
are broadcast. The strength of the L1 term is chosen by folds of the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.functions import arrow_udf

from tallyfold.llm.common import fresh, slices, text_or_empty
from tallyfold.llm.decontaminate import mix, word_keys

BITS = 20
MAX_TRAINING_ROWS = 16_000
#: Features of all training rows together, and rows by which the L1 strength is chosen.
MAX_TRAINING_FEATURES, CHOOSING_ROWS = 32 << 20, 4_000
SLICE_BYTES = 2 << 20
STEM = 5
THRESHOLD = 0.3
L1_STRENGTHS, FOLDS = (2.0, 4.0, 8.0), 3


def features(texts: list[str], bits: int, wanted: np.ndarray | None = None):
    """(text, bucket) of every distinct feature of the texts, as two arrays ordered by text.

    ``wanted`` (a flag for each bucket) leaves out the other buckets.
    """
    keys, counts = word_keys(texts)
    stems = word_keys(texts, STEM)[0]  # a short word is its own stem
    text = np.repeat(np.arange(len(texts)), counts)
    found_text, found = [], []
    for gap, words in ((0, keys), (0, stems), (1, keys), (2, keys)):
        n = max(0, len(words) - gap)
        feature = words if gap == 0 else mix(
            words[:n] * np.uint64(2 * gap + 1) ^ (words[gap:] >> np.uint64(1)))
        bucket = (mix(feature) >> np.uint64(64 - bits)).astype(np.int64)
        use = text[:n] == text[gap:]
        if wanted is not None:
            use &= wanted[bucket]
        found_text.append(text[:n][use])
        found.append(bucket[use])
    both = np.unique((np.concatenate(found_text) << bits) | np.concatenate(found))
    return both >> bits, both & ((1 << bits) - 1)


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2 terms; the last coordinate is the bias."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        gradient = sigmoid(w.sum()) - label
        rate = (np.sqrt(self.n[at] + gradient ** 2) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - rate * w
        self.n[at] += gradient ** 2


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, id_column: str, held_out: Column,
                  max_rows: int, text: str = "text") -> DataFrame:
    """(id, text, label, place) of the labelled rows that aren't held out, in the order of a hash of
    the id; of more than ``max_rows`` ids the first ones. An id with several labels has the highest.
    """
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
              .groupBy(F.col(id_column).alias("id")).agg(F.max("toxic").alias("label"))
              .where(~held_out).withColumn("place", F.xxhash64("id"))
              .orderBy("place", "id").limit(max_rows))
    return docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text")).join(
        F.broadcast(chosen), "id")


def fit(rows: list[tuple[int, np.ndarray]], bits: int, l1: float, alpha: float = 1.0,
        beta: float = 1.0, l2: float = 1.0, epochs: int = 2) -> np.ndarray:
    """Weights learned from (label, features) in their order, the bias last."""
    model = Ftrl(1 << bits, alpha, beta, l1, l2)
    for _ in range(epochs):
        for label, at in rows:
            model.learn(at, label)
    return model.weights()


def chosen_strength(rows: list[tuple[int, np.ndarray]], bits: int,
                    strengths: tuple[float, ...] = L1_STRENGTHS, folds: int = FOLDS) -> float:
    """The L1 strength whose models give the labels of folds that they haven't seen the most
    likelihood; the larger one of equals. Uses the first CHOOSING_ROWS rows."""
    some = rows[:CHOOSING_ROWS]
    losses = {}
    for l1 in strengths:
        losses[l1] = 0.0
        for fold in range(folds):
            w = fit([r for i, r in enumerate(some) if i % folds != fold], bits, l1)
            for label, at in some[fold::folds]:
                score = sigmoid(w[at].sum())
                losses[l1] -= float(np.log(max(score if label else 1 - score, 1e-12)))
    return min(strengths, key=lambda l1: (round(losses[l1], 9), -l1))


def train(rows: DataFrame, bits: int = BITS, l1: float | None = None,
          max_features: int = MAX_TRAINING_FEATURES, **options) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) other than zero; bucket ``2**bits`` is the bias. No rows: none.

    ``rows`` are those of ``training_rows``, which bounds their number: their features are made
    where the rows are, and one task runs over them, in the order of their places, up to
    ``max_features`` features in all (the sample's other bound). Without ``l1`` its strength is
    chosen by folds of these rows.
    """
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features([t], bits)[1].astype(np.int32) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["place"], batch["id"].cast(pa.string()), batch["label"].cast(pa.int32()),
                 pa.array(found, pa.list_(pa.int32()))], ["place", "id", "label", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, left = [], max_features
        for batch in batches:
            for label, found in zip(batch["label"].to_pylist(), batch["features"]):
                left -= len(found)
                if left >= 0:
                    rows.append((label, np.append(found.values.to_numpy(), np.int32(1 << bits))))
        weights = fit(rows, bits, chosen_strength(rows, bits) if l1 is None else l1, **options)
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(weights[kept])],
                                         ["bucket", "weight"])

    table = (rows.mapInArrow(hashed, "place long, id string, label int, features array<int>")
             .repartition(1).sortWithinPartitions("place", "id", "features")
             .mapInArrow(learn, "bucket long, weight double").toArrow())
    return table["bucket"].to_numpy(), table["weight"].to_numpy()


def scorer(spark, model: tuple[np.ndarray, np.ndarray], bits: int = BITS):
    """An Arrow UDF of a text column: the probability that the text is toxic."""
    sent = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        buckets, weights = sent.value
        dense = np.zeros((1 << bits) + 1)
        dense[buckets] = weights
        wanted = dense[:-1] != 0
        for batch in batches:
            sums = []
            for texts in slices(batch, SLICE_BYTES):
                text, bucket = features(texts, bits, wanted)
                sums.append(np.bincount(text, dense[bucket], len(texts)) + dense[-1])
            total = np.concatenate(sums) if sums else np.zeros(0)
            yield pa.array(sigmoid(total) if len(buckets) else np.zeros(len(batch)))

    return score


def scored(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", folds: int = 4,
           held_fold: int = 2, max_rows: int = MAX_TRAINING_ROWS, text: str = "text",
           training_docs: DataFrame | None = None, **options) -> DataFrame:
    """``docs`` with a struct column ``toxicity`` (underscores if taken): held_out, score, predicted.

    Labels come from rows whose crc32(id as text) mod ``folds`` isn't ``held_fold``, at most
    ``max_rows`` of them (the sample's bound). Every row gets a score, from its text alone: null and
    empty texts that of no feature. Without any training row all scores are 0. A null id counts as
    the empty text in the fold, and isn't learned from.
    """
    def fold(column: Column) -> Column:
        return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))),
                      F.lit(folds)) == held_fold

    rows = training_rows(docs if training_docs is None else training_docs, labels, id_column,
                         fold(F.col("id")), max_rows, text)
    bits = options.get("bits", BITS)
    score = scorer(docs.sparkSession, train(rows, **options), bits)(text_or_empty(text))
    name = fresh(docs, "toxicity")
    with_score = docs.withColumn(name, score)
    return with_score.withColumn(name, F.struct(
        fold(F.col(id_column)).alias("held_out"), F.col(name).alias("score"),
        (F.col(name) >= THRESHOLD).cast("int").alias("predicted")))


def not_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with their columns as they were."""
    judged = scored(docs, labels, **options)
    name = judged.columns[-1]
    return judged.where(F.col(name)["predicted"] == 0).drop(name)
