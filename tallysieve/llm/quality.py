"""Quality scores by positive-unlabelled learning.

Trusted positives and unlabelled text are each a bounded sample; the class prior is estimated from them, and a small
network minimises the non-negative unbiased risk: the positives' loss weighted by the prior, plus the part of the
unlabelled loss that the positives do not explain, never below zero. Inputs are statistics of the whole text alone.

NULL texts count as empty; empty texts get a score like any other. Rows without doc_id count as held out. Repeated
rows get the same score each. Without any positive to learn from, every score is 1. An empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, hash_order

#: Fitting sample: most positives and most unlabelled documents that are learnt from.
POSITIVES, UNLABELLED = 6000, 12000
HIDDEN, EPOCHS, BATCH, RATE, SEED = 16, 40, 600, 0.01, 5
#: Share of positives that the highest scores of the prior estimate must hold, so that the ratio is not noise.
LEAST_TAIL = 0.4
ACCEPT = 0.3
SCORED = "doc_id long, held_out boolean, score double, predicted int"

WORD_STATISTICS = 12
FEATURES = 128 + 2 + WORD_STATISTICS


def features(text: str | None) -> np.ndarray:
    """Shares of each ASCII character, share of longer ones, length, and statistics of words and lines."""
    out = np.zeros(FEATURES, "float32")
    body = (text or "").encode("utf-8", "surrogatepass")
    if not body:
        return out
    counts = np.bincount(np.frombuffer(body, "uint8"), minlength=256)
    out[:128] = np.sqrt(counts[:128] / len(body))
    out[128] = np.sqrt(counts[128:].sum() / len(body))
    out[129] = np.log1p(len(body))
    words = body.split()
    lines = [x for x in body.split(b"\n") if x and not x.isspace()]
    if words:
        lengths = np.fromiter(map(len, words), "float32", len(words))
        distinct = len(set(words))
        fives = len(set(zip(words, words[1:], words[2:], words[3:], words[4:])))
        upper = counts[65:91].sum()
        out[130:] = (
            np.log1p(len(words)), lengths.mean() / 10, lengths.std() / 10, lengths.max() ** 0.5 / 10, distinct / len(words),
            fives / max(1, len(words) - 4), len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)),
            np.log1p(len(words) / max(1, len(lines))), upper / max(1, upper + counts[97:123].sum()),
            sum(map(bytes.isalpha, words)) / len(words), sum(map(bytes.isupper, words)) / len(words),
        )
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.layers[0] + self.layers[1])
        return hidden @ self.layers[2] + self.layers[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype("float64")), -40, 40)))


def descend(x: np.ndarray, slopes, sizes: tuple[int, ...], epochs: int, seed: int) -> list[np.ndarray]:
    """Adam on a network of one hidden layer; `slopes(logits, batch)` is the loss's slope for each logit."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, sizes[0] ** -0.5, sizes), np.zeros(sizes[1]), rng.normal(0, sizes[1] ** -0.5, sizes[1]), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            hidden = np.tanh(x[pick] @ layers[0] + layers[1])
            d = slopes(hidden @ layers[2] + layers[3], pick)
            dh = d[:, None] * layers[2] * (1 - hidden**2)
            grads = [x[pick].T @ dh + 1e-4 * layers[0], dh.sum(0), hidden.T @ d, d.sum(keepdims=True)]
            step += 1
            for p, g, m, v in zip(layers, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return layers


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of the unlabelled to the positive share beyond a threshold: positives cannot be more than that.

    Returned is the lower end of its 95 % interval: with too high a prior, the risk has no room left for negatives.
    """
    cuts = np.quantile(positive, np.linspace(0, 1 - LEAST_TAIL, 60))
    share_p = np.array([(positive >= c).mean() for c in cuts])
    share_u = np.array([(unlabelled >= c).mean() for c in cuts])
    prior = (share_u / share_p).min()
    error = np.sqrt(prior * abs(1 - prior) * (1 / len(unlabelled) + 1 / len(positive)))
    return float(np.clip(prior - 1.64 * error, 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    x = np.concatenate([positive, unlabelled]).astype("float64")
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    is_p = np.arange(len(x)) < len(positive)
    sizes = (x.shape[1], HIDDEN)
    if prior is None:
        # A discriminator of positives from unlabelled text, fitted on one half, orders the other half for the estimate.
        half = np.random.default_rng(SEED).random(len(x)) < 0.5
        weight = np.where(is_p, 0.5 / max(1, (is_p & half).sum()), 0.5 / max(1, (~is_p & half).sum())) * half.sum()

        def apart(logits, pick):
            rows = np.flatnonzero(half)[pick]
            return weight[rows] * (logistic(logits) - is_p[rows]) / len(pick)

        layers = descend(x[half], apart, sizes, max(4, EPOCHS // 4), SEED)
        ranked = np.tanh(x[~half] @ layers[0] + layers[1]) @ layers[2]
        prior = class_prior(ranked[is_p[~half]], ranked[~is_p[~half]])

    def slopes(logits, pick):
        p, s = is_p[pick], logistic(logits)
        n_p, n_u = max(1, p.sum()), max(1, (~p).sum())
        as_negative = np.logaddexp(0, logits)  # loss of calling a row negative
        unexplained = as_negative[~p].sum() / n_u - prior * as_negative[p].sum() / n_p
        negative = np.where(p, -prior * s / n_p, s / n_u)
        if unexplained < 0:  # the corrected risk went below zero: step back instead of fitting it further
            return -negative
        return np.where(p, prior * (s - 1) / n_p, 0) + negative

    return Model(mean, scale, descend(x, slopes, sizes, EPOCHS, SEED), prior)


def featurise(docs: DataFrame) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "features": [features(t).tobytes() for t in frame["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, features binary")


def drawn(ids: DataFrame, docs: DataFrame, most: int) -> np.ndarray:
    """Features of a bounded sample, drawn by a hash of the id."""
    few = ids.select("doc_id").orderBy(hash_order(F.col("doc_id")), "doc_id").limit(most).distinct()
    rows = featurise(docs.join(F.broadcast(few), "doc_id")).toPandas().sort_values(["doc_id", "features"], kind="stable")
    return np.stack([np.frombuffer(f, "float32") for f in rows["features"]]) if len(rows) else np.empty((0, FEATURES), "float32")


def train(docs: DataFrame, labels: DataFrame, held_out: Column) -> Model | None:
    """`held_out` names rows, of both tables, that nothing is learnt from."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out)
    trusted = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).where(~held_out)
    positive = drawn(trusted, docs, POSITIVES)
    unlabelled = drawn(docs, docs, UNLABELLED)
    return fit(positive, unlabelled) if len(positive) else None


def score_texts(docs: DataFrame, model: Model | None, column: str) -> DataFrame:
    """All columns of `docs` and the score of its text; rows are neither joined nor moved."""
    weights = pickle.dumps(model)  # 20 kB

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net = pickle.loads(weights)
        for part in parts:
            if net is None or part.empty:
                yield pd.Series(np.ones(len(part)))
            else:
                yield pd.Series(net.scores(np.stack([features(t) for t in part])))

    return docs.withColumn(column, score(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    held_out = fold(F.col("doc_id"), 5) == 0
    model = train(docs, labels, held_out)
    scored = score_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model, "score")
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= accept).cast("int").alias("predicted"),
    )
