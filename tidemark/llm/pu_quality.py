"""Quality classifier by positive-unlabelled learning.

Trusted positives are texts marked good; everything else counts as unlabelled web text, whatever marks
it has. A small network on text statistics minimises the non-negative unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss; where the second part falls below zero, its gradient is reversed, which keeps
the network from memorising the positives. The class prior is estimated from positives and unlabelled texts
alone: whatever set of texts one takes, its share of the unlabelled ones is at least the prior times its share of the
positives, and equal where no bad text lies in it. The sets are the upper tails of the scores that a network gives,
trained on one half of the sample to tell positives from unlabelled and applied to the other, and the prior is the
least of these ratios. Training takes bounded samples (about ``most_positive`` and ``most_unlabelled`` texts), chosen by the hash of
the ids; of several texts of one id, the one of the least hash counts. Scoring is one pass over whole texts without a
shuffle, and ids, sources, languages and marks are no features.

Null and empty texts score 0. If there is no positive to learn from, all scores are 0. Repeated rows get
the same score; empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import blocks, chosen, grams, owners, words

#: Classes of bytes: 0 white space, 1 line feed, 2 upper case, 3 lower case, 4 digit, 5 stop or comma,
#: 6 other ASCII, 7 beyond ASCII.
CLASSES = np.full(256, 6, np.int64)
CLASSES[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
CLASSES[0x0A] = 1
CLASSES[65:91], CLASSES[97:123], CLASSES[48:58], CLASSES[[44, 46]], CLASSES[128:] = 2, 3, 4, 5, 7
WIDTH, FEW = 14, 20


def _repeated(code: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Share of entries of each text that occur in it before."""
    total = np.bincount(owner, minlength=n)
    key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (code >> np.uint64(24)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n)
    return 1 - distinct / np.maximum(total, 1)


def features(texts: pa.Array) -> np.ndarray:
    """Statistics of whole texts, a row each."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for i, j, data, offsets in blocks(texts):
        n, size = j - i, np.diff(offsets)
        owner = np.repeat(np.arange(n), size)
        kinds = CLASSES[data]
        counts = np.bincount(owner * 8 + kinds, minlength=8 * n).reshape(n, 8)
        part = out[i:j]
        part[:, :8] = counts / np.maximum(size, 1)[:, None]
        twice = np.zeros(len(data), bool)
        twice[1:] = (data[1:] == data[:-1]) & (kinds[1:] == 6)
        part[:, 8] = np.bincount(owner[twice], minlength=n) / np.maximum(size, 1)
        w = words(data, offsets)
        held = owners(w.first)
        total = np.maximum(np.diff(w.first), 1)
        part[:, 9] = np.bincount(held, w.end - w.start, n) / total / 10
        part[:, 10] = np.log1p(np.diff(w.first)) / 10
        part[:, 11] = _repeated(w.hash, held, n)
        for column, k in ((12, 3), (13, 8)):
            code = grams(w.hash, k)
            same = held[: len(code)] == held[k - 1 :] if len(code) else np.empty(0, bool)
            part[:, column] = _repeated(code[same], held[: len(code)][same], n)
    return out


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.tanh(((x - self.mean) / self.spread) @ a + b) @ c + d

    def score(self, texts: pa.Array) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(self.logits(features(texts)).astype(np.float64), -30, 30)))
        empty = np.array([not x for x in texts.is_valid().to_numpy(zero_copy_only=False)]) if len(texts) else np.empty(0, bool)
        length = np.concatenate([np.diff(o) for _, _, _, o in blocks(texts)]) if len(texts) else np.empty(0)
        return np.where(empty | (length == 0), 0.0, p)


def slopes(layers: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> list[np.ndarray]:
    """Gradient of the risk on a minibatch; where the unlabelled part is negative, its own gradient, reversed."""
    x, n = np.concatenate([positive, unlabelled]), len(positive)
    h = np.tanh(x @ layers[0] + layers[1])
    z = np.clip(h @ layers[2] + layers[3], -30, 30)
    good = 1 / (1 + np.exp(-z))
    rest = np.logaddexp(0, z[n:]).mean() - prior * np.logaddexp(0, z[:n]).mean()
    back = np.zeros(len(x))
    as_bad = np.concatenate([-prior * good[:n] / n, good[n:] / len(unlabelled)])
    if rest < 0:
        back = -as_bad
    else:
        back[:n] = prior * (good[:n] - 1) / n
        back += as_bad
    inner = np.outer(back, layers[2]) * (1 - h * h)
    return [x.T @ inner, inner.sum(axis=0), h.T @ back, np.array([back.sum()])]


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, epochs: int = 150, seed: int = 5) -> Model:
    """Non-negative risk minimisation by Adam on minibatches."""
    random = np.random.default_rng(seed)
    mean, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p, u = (positive - mean) / spread, (unlabelled - mean) / spread
    layers = [
        random.normal(0, 0.5, (WIDTH, hidden)), np.zeros(hidden), random.normal(0, 0.3, hidden), np.zeros(1)
    ]
    first, second = ([np.zeros_like(x) for x in layers] for _ in range(2))
    step, size = 0, 256
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = random.permutation(len(u))
        for k in range(0, len(u), size):
            xu = u[order[k : k + size]]
            xp = p[random.integers(0, len(p), min(size, len(p)))]
            step += 1
            for w, g, m, v in zip(layers, slopes(layers, xp, xu, prior), first, second, strict=True):
                g = g + 1e-4 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, layers, prior)


def prior_of(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.3, seed: int = 5) -> float:
    """Share of positives among the unlabelled: the least ratio of the upper tails of their scores.

    Tails hold at least the share ``least`` of the positives. Each half is scored by a network that has not seen
    it. Of fewer than ``FEW`` texts on either side nothing can be said, and the prior is a half.
    """
    if min(len(positive), len(unlabelled)) < FEW:
        return 0.5
    scores = []
    for side in (0, 1):
        fit = [x[1 - side :: 2] for x in (positive, unlabelled)]
        model = train(*fit, prior=0.5, epochs=60, seed=seed)
        scores.append([model.logits(x[side::2]) for x in (positive, unlabelled)])
    ratios = []
    for p, u in scores:
        cuts = np.quantile(p, np.linspace(0, 1 - least, 36))
        ratios.append(((u[:, None] >= cuts).mean(axis=0) / (p[:, None] >= cuts).mean(axis=0)).min())
    return float(np.clip(np.mean(ratios), 0.01, 0.99))


def learn(
    docs: DataFrame, labels: DataFrame, wanted: Column, most_positive: int = 3000, most_unlabelled: int = 6000
) -> Model | None:
    """Train from ``labels`` (doc_id, quality) of the wanted rows and the wanted documents.

    ``wanted`` is an expression over ``doc_id``.
    """
    positives = chosen(labels.where(wanted & (F.col("quality") == 1)), most_positive)
    unlabelled = chosen(docs.where(wanted), most_unlabelled)
    sides = [{r[0] for r in side.collect()} for side in (positives, unlabelled)]
    picked = docs.where(F.col("doc_id").isin(list(sides[0] | sides[1]))).select("doc_id", "text")
    measured = picked.mapInArrow(_measured, "doc_id long, hash long, x array<float>")
    one = measured.groupBy("doc_id").agg(F.min_by("x", F.struct("hash", "x")).alias("x")).collect()
    x = {r["doc_id"]: np.array(r["x"], np.float32) for r in one}
    good, rest = ([x[i] for i in sorted(side) if i in x] for side in sides)
    if not good or not rest:
        return None
    good, rest = np.stack(good), np.stack(rest)
    return train(good, rest, prior_of(good, rest))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = features(batch.column(1))
        offsets = pa.array(np.arange(0, values.size + 1, WIDTH, dtype=np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
        digest = [hashlib.sha256((x.as_py() or "").encode()).digest()[:8] for x in batch.column(1)]
        hashes = pa.array(np.frombuffer(b"".join(digest), "<i8"))
        yield pa.RecordBatch.from_arrays([batch.column(0), hashes, lists], names=["doc_id", "hash", "x"])


def scored(docs: DataFrame, model: Model | None, good: float = 0.7) -> DataFrame:
    """doc_id, score and predicted (1 from ``good`` on) of every row."""
    score = F.lit(0.0)
    if model is not None:
        shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

        @F.arrow_udf("double")
        def rated(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for part in parts:
                yield pa.array(shared.value.score(part))

        score = rated(F.col("text"))
    found = docs.select("doc_id", score.alias("score"))
    return found.select("doc_id", "score", (F.col("score") >= good).cast("int").alias("predicted"))
