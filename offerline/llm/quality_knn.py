"""Quality by nearest-neighbour voting in a latent semantic space.

A text's terms are pairs of neighbouring bytes (bytes folded to 64 classes)
and a few terms for words said again. Weighted by inverse document frequency
and projected on the leading singular directions of a bounded labelled
sample, every text becomes a short unit vector. The sample's vectors and
labels are broadcast (their number is bounded by ``PER_CLASS``); every
document is compared with all of them, block by block, by one matrix product,
and the labels of its nearest neighbours vote with a weight that grows with
the similarity.

Rows: a null or empty text has no vector and gets the mean label of the
sample; equal similarities at the edge of the neighbourhood are taken in
sample order; rows equal in id and text count once in the sample, an id on
many rows brings no more than the sample's bound, one of several labels is
its smallest; without any labelled row every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerline.llm import common

PER_CLASS = 1000    # documents of each label in the sample: the bound of what is broadcast
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8
FOLD = np.array([c - 97 if 97 <= c <= 122 else 26 if 65 <= c <= 90 else 27 if 48 <= c <= 57 else 28 if c == 32 else 29 if c == 10
                 else 30 if c < 32 else 63 if c >= 128 else 31 + (c - 33 if c < 48 else c - 43 if c < 65 else c - 69 if c < 97 else c - 95)
                 for c in range(256)], np.int64)
PAIRS = 64 * 64
AGAIN = 3           # terms of repetition: next word, earlier word, earlier line
TERMS = PAIRS + AGAIN


def term_weights(texts: list[str]) -> np.ndarray:
    """One row of term weights a text: shares of the byte pairs under a
    square root, and shares of repeated words and lines."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            continue
        code = FOLD[np.frombuffer(data, np.uint8)]
        if len(code) > 1:
            out[i, :PAIRS] = np.sqrt(np.bincount(code[:-1] * 64 + code[1:], minlength=PAIRS) / (len(code) - 1))
        words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
        if len(words) > 1:
            out[i, PAIRS] = sum(map(bytes.__eq__, words, words[1:])) / (len(words) - 1)
            out[i, PAIRS + 1] = (1 - len(set(words)) / len(words)) * 0.2
        if len(lines) > 1:
            out[i, PAIRS + 2] = 1 - len(set(lines)) / len(lines)
    return out


class Space:
    """The latent space and the labelled vectors in it."""

    def __init__(self, weights: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS):
        self.idf = np.log((1 + len(weights)) / (1 + (weights > 0).sum(axis=0))).astype(np.float32) + np.float32(0.2)
        self.idf[PAIRS:] = 2
        own = self.scaled(weights)
        rng = np.random.default_rng(7)
        span = own.T @ (own @ rng.standard_normal((TERMS, dimensions + 16)).astype(np.float32))
        for _ in range(3):      # subspace iteration
            span = own.T @ (own @ np.linalg.qr(span)[0])
        basis = np.linalg.qr(span)[0]
        _, _, turn = np.linalg.svd(own @ basis, full_matrices=False)
        self.basis = np.ascontiguousarray((basis @ turn.T)[:, :dimensions])
        self.labels = labels.astype(np.float32)
        self.vectors = self.project(weights)

    def scaled(self, weights: np.ndarray) -> np.ndarray:
        x = weights * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def project(self, weights: np.ndarray) -> np.ndarray:
        x = self.scaled(weights) @ self.basis
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str], neighbours: int = NEIGHBOURS) -> np.ndarray:
        weights = term_weights(texts)
        near = self.project(weights) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        rank = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, rank, axis=1), 0) ** SHARPNESS
        total = weight.sum(axis=1)
        prior = self.labels.mean()
        vote = (weight * self.labels[rank]).sum(axis=1)
        return np.clip(np.where(total > 0, vote / np.maximum(total, 1e-12), prior), 0, 1).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, learnable, per_class: int = PER_CLASS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Space | None:
    """The space of at most ``per_class`` distinct labelled documents of each
    label, those of the smallest id hash."""
    marked = (labels.filter(learnable).filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("g"))
              .filter(F.col("g").isin(0, 1)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), common.text_of(text_col).alias("t"))
    known = common.materialize(marked.join(texts.select("id").distinct(), "id", "left_semi").select("g", "id"), "labelled")
    sample = common.sample_texts(texts, known, per_class, "quality").select("id", "t", F.col("g").alias("y"), "r")

    def run(batch: pa.RecordBatch):
        for a in range(0, batch.num_rows, 64):
            part = batch.slice(a, 64)
            weights = term_weights(part.column(1).to_pylist()).astype(np.float16)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array([w.tobytes() for w in weights], pa.binary())],
                                             ["id", "y", "r", "w"])

    rows = common.map_batches(sample, run, "id long, y int, r int, w binary").orderBy("id", "r").toArrow()
    if not rows.num_rows:
        return None
    weights = np.frombuffer(b"".join(rows["w"].to_pylist()), np.float16).reshape(-1, TERMS).astype(np.float32)
    return Space(weights, rows["y"].to_numpy())


def scores(docs: DataFrame, space: Space | None, id_col: str = "doc_id", text_col: str = "text", carry: tuple = ()) -> DataFrame:
    """(id, score) and the columns of ``carry``, per row."""
    sent = docs.sparkSession.sparkContext.broadcast(space)
    names = ["id", *[f"carry_{i}" for i in range(len(carry))]]

    def run(batches):
        own = sent.value
        for batch in batches:
            out = []
            for a in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(a, 256).to_pylist()
                out.append(own.score(texts) if own else np.full(len(texts), 0.5))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(out) if out else np.zeros(0))], [*names, "score"])

    rows = docs.select(common.text_of(text_col).alias("t"), F.col(id_col).cast("long").alias("id"),
                       *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)])
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(common.trimming(run), ", ".join(f"{n} {kinds[n]}" for n in names) + ", score double").withColumnsRenamed(
        {f"carry_{i}": c for i, c in enumerate(carry)})
