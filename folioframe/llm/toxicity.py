"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the *set* of its hashed words, word pairs and word pairs
with one or two words skipped. Rates are per coordinate, and so is the L1
strength: a coordinate's weight stays zero while its gradient sum is within
``l1`` standard deviations of what chance would give it, plus what one document
can add. So L1 leaves few weights, whose number is checked before they are
broadcast and applied to whole texts.

Defined results: null and empty texts have no feature and get the bias alone as
score; repeated rows are scored each; rows without a label or with one that is
not 0 or 1 are not learned from, a document with both labels counts as 1, and of
several texts of one id the least is learned from; with nothing to learn from,
every score is 0.5 and the filter keeps every document. Only the named columns
are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, arrow_schema, batch_of, held_out, id_and_text, learnable, on_workers, slices, words_of, written

_hash = partial(xxhash.xxh64_intdigest, seed=7)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
#: Distinct words a worker remembers before it starts afresh.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Ftrl:
    """``sample_rows`` and ``sample_bytes`` bound the labelled documents learned from: those with the smallest hashed ids.

    ``l1`` is in standard deviations of a coordinate's gradient sum (see ``train``).
    """

    bits: int = 32
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 1.5
    l2: float = 0.1
    epochs: int = 2
    sample_rows: int = 10_000
    sample_bytes: int = 64 << 20
    threshold: float = 0.3


class Features:
    def __init__(self, bits: int):
        self.shift, self.words = np.uint64(64 - bits), {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Hashed features of a text, repeats included."""
        words = words_of(text)
        if not words:
            return np.zeros(0, np.uint32)
        known = self.words
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = _hash(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        parts = [h * _ODD[0]]
        for gap in (1, 2, 3):
            if len(h) > gap:
                x = (h[:-gap] + _ODD[gap]) * _ODD[0] ^ (h[gap:] * _ODD[gap] >> np.uint64(7))
                parts.append(x * _ODD[1])
        return (np.concatenate(parts) >> self.shift).astype(np.uint32)


def prior_of(labels: np.ndarray) -> float:
    return min(max(labels.mean(), 1e-3), 1 - 1e-3)


def weights_of(z: np.ndarray, n: np.ndarray, l1: np.ndarray, p: Ftrl) -> np.ndarray:
    """FTRL-proximal in closed form: zero within the L1 strength, else against z at the coordinate's own rate."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def _places(active: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Coordinates of a text's features among the active ones, counted from one, and the bias, which is 0."""
    at = np.searchsorted(active, features)
    at[at == len(active)] = 0
    return np.append(at[active[at] == features] + 1, 0) if len(active) else np.zeros(1, np.int64)


def train(examples: list[tuple[np.ndarray, int]], p: Ftrl) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights (feature, value), features in order; feature -1, the first, is the bias,
    which starts at the prior's log odds and L1 spares.

    A coordinate keeps z, the sum n of its squared gradients, and the sum v of
    the variances q(1-q) that its documents' predictions q have, none less than
    the prior's. Its L1 strength over E epochs is E + l1 sqrt(E v): the most that
    one document can add, and ``l1`` deviations of a sum of chance gradients. A
    coordinate of k documents has |z| <= kE and v >= kE prior(1-prior), so with
    k <= 1 + l1 sqrt(k prior(1-prior)) its weight is zero whatever the labels: it
    is left out from the start, which changes no result.
    """
    prior = prior_of(np.array([y for _, y in examples], float))
    least, base = prior * (1 - prior), np.log(prior / (1 - prior))
    every, counts = np.unique(np.concatenate([f for f, _ in examples]), return_counts=True)
    active = every[counts > 1 + p.l1 * np.sqrt(counts * least)]
    del every, counts
    rows = [(_places(active, f), y) for f, y in examples]
    z, n, v = np.zeros((3, len(active) + 1))
    free = np.arange(len(z)) == 0

    def weight(i: np.ndarray) -> np.ndarray:
        return weights_of(z[i], n[i], np.where(free[i], 0.0, p.epochs + p.l1 * np.sqrt(p.epochs * v[i])), p)

    for _ in range(p.epochs):
        for i, label in rows:
            w = weight(i)
            q = 1 / (1 + np.exp(-np.clip(base + w.sum(), -35, 35)))
            g = q - label
            squared = n[i] + g * g
            z[i] += g - (np.sqrt(squared) - np.sqrt(n[i])) / p.alpha * w
            n[i] = squared
            v[i] += max(q * (1 - q), least)
    w = weight(np.arange(len(active) + 1))
    w[0] += base
    some = np.flatnonzero(w[1:]) + 1
    return np.concatenate([[-1], active[some - 1].astype(np.int64)]), np.concatenate([w[:1], w[some]])


class Model:
    """Logit of a text under sparse weights."""

    def __init__(self, weights: tuple[np.ndarray, np.ndarray], p: Ftrl):
        self.of, self.bias = Features(p.bits), float(weights[1][0]) if len(weights[1]) else 0.0
        self.features, self.weights = weights[0][1:].astype(np.uint32), weights[1][1:]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.features & np.uint32(0xFFFF)] = True

    def __call__(self, text: str | None) -> float:
        f = self.of(text)
        f = f[self.maybe[f & np.uint32(0xFFFF)]]
        return self.bias + float(self.weights[np.isin(self.features, f)].sum()) if len(f) else self.bias


def sample(docs: DataFrame, labels: DataFrame, p: Ftrl, label_col: str = "toxic") -> DataFrame:
    """(key, label, text) of the labelled documents learned from, one row an id, within both bounds.

    The bytes are added up over sizes alone, so texts beyond the bound are left where they are.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.filter(F.col("label").isin(0, 1) & learnable()).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = marked.withColumn("key", F.xxhash64("doc_id")).orderBy("key", "doc_id").limit(p.sample_rows)
    texts = id_and_text(docs).join(F.broadcast(chosen), "doc_id").groupBy("key", "doc_id", "label").agg(F.min("text").alias("text"))
    texts = written(texts, "labelled")
    sizes = texts.select("key", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    # one window over as many pairs of numbers as the bound above lets through
    held = F.sum("bytes").over(Window.orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    within = sizes.withColumn("held", held).filter(F.col("held") <= p.sample_bytes).select("doc_id")
    return texts.join(F.broadcast(within), "doc_id", "left_semi").select("key", "label", "text")


def fit(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl(), label_col: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Learn from the bounded sample; features are hashed by many tasks, the fitting itself is one task."""
    sparse = arrow_schema(key=pa.int64(), label=pa.int32(), features=pa.binary())

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(p.bits)
        for b in slices(batches):
            yield batch_of(sparse, b["key"], b["label"], [np.unique(of(t)).tobytes() for t in b["text"].to_pylist()])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [(np.frombuffer(f, np.uint32), y) for b in batches for f, y in zip(b["features"].to_pylist(), b["label"].to_pylist(), strict=True)]
        if any(len(f) for f, _ in examples):
            i, w = train(examples, p)
            yield batch_of(arrow_schema(i=pa.int64(), w=pa.float64()), pa.array(i, pa.int64()), pa.array(w, pa.float64()))

    texts = sample(docs, labels, p, label_col).repartition(docs.sparkSession.sparkContext.defaultParallelism, "key")
    features = arrow_map(texts, hashed, "key long, label int, features binary")
    table = arrow_map(features.repartition(1).sortWithinPartitions("key"), learned, "i long, w double").toArrow()
    return table["i"].to_numpy(), table["w"].to_numpy()


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray], p: Ftrl = Ftrl()) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(checked(weights))
    out = arrow_schema(doc_id=pa.int64(), score=pa.float64())

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value, p)
        for b in slices(batches):
            logits = np.array([model(t) for t in b["text"].to_pylist()], float)
            yield batch_of(out, b["doc_id"], pa.array(1 / (1 + np.exp(-np.clip(logits, -35, 35)))))

    predicted = (F.col("score") >= p.threshold).cast("int").alias("predicted")
    return arrow_map(id_and_text(docs), scored, "doc_id long, score double").select("doc_id", held_out().alias("held_out"), "score", predicted)


def checked(weights: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights are broadcast only within this bound; L1 keeps them far below it."""
    if len(weights[0]) > 1_000_000:
        raise ValueError("more active features than are broadcast: raise l1")
    return weights


def toxicity(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    return score(docs, fit(docs, labels, p), p)


def drop_toxic(docs: DataFrame, labels: DataFrame, p: Ftrl = Ftrl()) -> DataFrame:
    """Documents that the model does not reject, all their columns kept.

    The text is scored where it stands, so no join is needed and repeated or
    null ids are judged row by row. With nothing to learn from, there is no
    model to reject any: all documents are kept.
    """
    weights = checked(fit(docs, labels, p))
    if not len(weights[0]):
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    on_workers(docs.sparkSession)

    @F.pandas_udf("double")
    def logit(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Model(shared.value, p)
        for texts in parts:
            yield pd.Series(list(map(model, texts)), dtype="float64")

    return docs.filter(logit(F.col("text").cast("string")) < float(np.log(p.threshold / (1 - p.threshold))))
