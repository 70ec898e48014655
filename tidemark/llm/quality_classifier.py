"""Quality by nearest-neighbour voting over latent-semantic vectors.

A bounded labelled sample (``NEIGHBOURS`` rows, never held-out ones) gives
hashed character-trigram and word-repetition counts; inverse document
frequencies and a truncated SVD of that sample make the latent space.  The
projection and the labelled vectors (a fixed few MB whatever the corpus) go to
every task, which forms exact cosines for blocks of documents by one matrix
product and lets the ``K`` nearest labelled vectors vote by similarity.

Edge cases: null and empty texts have the zero vector and get the sample's
share of good rows; very long texts are read whole; repeated rows score alike;
without labels every score is 0.5; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, labelled_sample, words_of

NEIGHBOURS = 4000
DIMENSIONS = 64
BUCKETS = 2048
EXTRA = 24
K = 25
POWER = 8
THRESHOLD = 0.7
BLOCK = 512


def counts(text: str) -> np.ndarray:
    """Log-scaled hashed trigram counts per length, then bins of repetition, symbols and case."""
    out = np.zeros(BUCKETS + EXTRA, dtype=np.float32)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return out
    grams = (raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA6B) ^ raw[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    out[:BUCKETS] = np.sqrt(np.bincount(grams >> np.uint32(21), minlength=BUCKETS) / len(grams))
    words = words_of(text)
    n = len(words)
    if n:
        pairs = list(zip(words, words[1:], words[2:]))
        lines = [x for x in text.split("\n") if x]
        shares = (1 - len(set(pairs)) / max(1, len(pairs)), sum(a == b for a, b in zip(words, words[1:])) / n,
                  1 - len(set(lines)) / max(1, len(lines)), sum(text.count(c) for c in "#*$%&|") / n,
                  sum(text.count(c) for c in "!?") / n, float(((raw >= 65) & (raw <= 90)).sum()) / len(raw))
        for i, x in enumerate(shares):
            out[BUCKETS + 4 * i + min(3, int(x * 8))] = 0.35 if x > 0.02 else 0.0
    return out


@dataclass
class Votes:
    """Projection (features x dimensions), labelled unit vectors, their labels, and the share of good rows."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        x = rows @ self.projection
        norm = np.linalg.norm(x, axis=1)
        sim = (x / np.where(norm, norm, 1)[:, None]) @ self.vectors.T
        k = min(K, len(self.labels))
        top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(sim, top, 1), 0, 1).astype(float) ** POWER + 1e-9
        score = (weight * self.labels[top]).sum(1) / weight.sum(1)
        return np.where(norm > 0, np.clip(score, 0, 1), self.base)


def fit(docs: DataFrame, labels: DataFrame, limit: int = NEIGHBOURS) -> Votes:
    """The latent space and the labelled vectors from a bounded sample."""
    def start():
        return lambda texts: {"f": [counts(t).tobytes() for t in texts]}

    rows = sorted(add_columns(labelled_sample(docs, labels, "quality", limit), ["doc_id", "y"], start, "f binary").collect(), key=lambda r: r["doc_id"])
    if not rows:
        return Votes(np.zeros((BUCKETS + EXTRA, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    x = np.stack([np.frombuffer(r["f"], dtype=np.float32) for r in rows])
    y = np.array([r["y"] for r in rows], dtype=float)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 0.3
    idf[BUCKETS:] = 1.0
    gram = (x * idf).T @ (x * idf)
    values, vectors = np.linalg.eigh(gram.astype(np.float64))
    projection = (idf[:, None] * vectors[:, ::-1][:, :min(DIMENSIONS, len(x))]).astype(np.float32)
    z = x @ projection
    norm = np.linalg.norm(z, axis=1)
    z = (z / np.where(norm, norm, 1)[:, None]).astype(np.float32)
    return Votes(projection, z, y, float(y.mean()))


def score(docs: DataFrame, votes: Votes) -> DataFrame:
    """doc_id, score, predicted of every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(votes)

    def start():
        model = shared.value

        def run(texts: list[str]) -> dict:
            out: list[float] = []
            for i in range(0, len(texts), BLOCK):
                out.extend(model.scores(np.stack([counts(t) for t in texts[i:i + BLOCK]])).tolist())
            return {"score": out}
        return run

    return add_columns(docs, ["doc_id"], start, "score double").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
