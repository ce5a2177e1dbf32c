"""Quality by positive-unlabelled learning.

Trusted positives and unlabelled text train a small network on numbers that describe
the shape of a text: shares of character kinds, repetition, word and line lengths.
Negative labels are never used. The risk of calling unlabelled text negative holds the
positives hidden in it; their part, the class prior times the positives' own risk, is
taken off, and the remainder is kept from going below zero (the non-negative estimator).

The class prior is estimated first: a classifier of positives against unlabelled text
ranks held-back texts of both kinds, and the least ratio, over all thresholds, of the
unlabelled to the positive share above the threshold bounds the prior.

Defined cases: a null text counts as empty and is scored like one; without positives
every text gets 0, without unlabelled text every text gets 1; repeated rows are each
scored; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import bounded_sample, with_text

HIDDEN, STEPS, BATCH, RATE, DECAY = 24, 600, 4096, 0.01, 1e-4
SLACK = 0.01  # how far the non-negative part may go below zero before its gradient is undone
KINDS = 9


def _kinds() -> np.ndarray:
    """The kind of each byte: small, large, digit, blank, line end, stop, quote or dash, other sign, beyond ASCII."""
    kinds = np.full(256, 7, np.uint8)
    for kind, these in enumerate(
        (range(97, 123), range(65, 91), range(48, 58), b" \t", b"\n\r", b".,;:?", b"'\"()-")
    ):
        kinds[list(these)] = kind
    kinds[128:] = 8
    return kinds


_KIND = _kinds()
_SIGNS = re.compile(r"[^\w\s.,;:?'\"()\-]")


def describe(text: str | None) -> list[float]:
    """Numbers that do not grow with the length of the text, but for the first, its logarithm."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    words = (text or "").split()
    if not words:
        return [0.0] * 22
    kinds = np.bincount(_KIND[raw], minlength=KINDS) / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    top = counts.most_common(3)
    lines = [x for x in text.split("\n") if x.strip()]
    line_words = len(words) / len(lines)
    again = sum(map(str.__eq__, words, words[1:])) / len(words)
    return [
        float(np.log1p(len(words))),
        *kinds.tolist(),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        float((lengths == 1).mean()),
        float(np.log(len(counts)) / np.log(len(words) + 1)),
        top[0][1] / len(words),
        sum(n for _, n in top) / len(words),
        again,
        len(set(lines)) / len(lines),
        float(np.log1p(line_words)),
        sum(x.rstrip()[-1] in ".!?:;" for x in lines) / len(lines),
        len(_SIGNS.findall(text)) / len(words),
    ]


def describe_all(texts: pd.Series) -> np.ndarray:
    return np.array([describe(t) for t in texts], float).reshape(len(texts), -1)


@dataclass
class Network:
    middle: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]  # weights, offsets, weights, offset

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # numbers far outside of what training saw must not decide alone
        z = np.clip((x - self.middle) / self.scale, -8, 8)
        return z, np.tanh(z @ self.layers[0] + self.layers[1])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return (self.hidden(x)[1] @ self.layers[2] + self.layers[3])[:, 0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, rng) -> Network:
    """Minimise the non-negative risk at ``prior``; without a prior, tell positives from unlabelled text."""
    both = np.concatenate([positive, unlabelled])
    width = both.shape[1]
    net = Network(
        both.mean(0),
        both.std(0) + 1e-6,
        [
            rng.normal(0, width**-0.5, (width, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)),
            np.zeros(1),
        ],
    )
    mean, spread = [np.zeros_like(w) for w in net.layers], [np.zeros_like(w) for w in net.layers]
    step = 0
    # large batches: the part taken off must not swing with the positives that chance deals to a batch
    parts = max(1, min(len(positive), len(unlabelled)) // BATCH)
    for _ in range(-(-STEPS // parts)):
        pairs = zip(
            np.array_split(rng.permutation(len(positive)), parts), np.array_split(rng.permutation(len(unlabelled)), parts)
        )
        for p, u in pairs:
            x = np.concatenate([positive[p], unlabelled[u]])
            z, h = net.hidden(x)
            g = (h @ net.layers[2] + net.layers[3])[:, 0]
            s, n = _sigmoid(g), len(p)
            # logistic loss: slope of l(g, +1) is s - 1, of l(g, -1) is s
            slope = np.zeros(len(x))
            if prior is None:
                slope[:n], slope[n:] = (s[:n] - 1) / n, s[n:] / len(u)
            else:
                softplus = np.logaddexp(0, g)
                rest = softplus[n:].mean() - prior * softplus[:n].mean()
                if rest >= -SLACK:
                    slope[:n] = prior * (s[:n] - 1) / n - prior * s[:n] / n
                    slope[n:] = s[n:] / len(u)
                else:
                    slope[:n], slope[n:] = prior * s[:n] / n, -s[n:] / len(u)
            back = slope[:, None] @ net.layers[2].T * (1 - h * h)
            gradients = [z.T @ back, back.sum(0), h.T @ slope[:, None], slope.sum(keepdims=True)]
            step += 1
            for i, d in enumerate(gradients):
                d = d + DECAY * net.layers[i]
                mean[i] = 0.9 * mean[i] + 0.1 * d
                spread[i] = 0.999 * spread[i] + 0.001 * d * d
                net.layers[i] -= RATE * (mean[i] / (1 - 0.9**step)) / (np.sqrt(spread[i] / (1 - 0.999**step)) + 1e-8)
    return net


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, rng) -> float:
    """The share of positives in unlabelled text, from the best threshold of a held-back half."""
    half = lambda x: (x[::2], x[1::2])
    (p, p_held), (u, u_held) = half(positive), half(unlabelled)
    net = _train(p, u, None, rng)
    above_p, above_u = net.margin(p_held), net.margin(u_held)
    cuts = np.quantile(above_p, np.linspace(0, 0.9, 91))
    share_p = (above_p[None, :] >= cuts[:, None]).mean(1)
    share_u = (above_u[None, :] >= cuts[:, None]).mean(1)
    # the margin for chance keeps thresholds that few texts pass from winning
    chance = np.sqrt(np.log(20) / 2) * (len(p_held) ** -0.5 + len(u_held) ** -0.5)
    best = int(np.argmin((share_u + chance) / share_p))
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.98))


def fit(positive: list[str], unlabelled: list[str], seed: int = 11) -> tuple[Network, float]:
    rng = np.random.default_rng(seed)
    p, u = describe_all(positive), describe_all(unlabelled)
    prior = estimate_prior(p, u, rng)
    return _train(p, u, prior, rng), prior


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column) -> Network | float:
    """A network, or the constant score, from a bounded sample.

    Positives are documents where ``learn`` holds and ``labels`` (key, label) has label 1.
    All others where ``learn`` holds are unlabelled, whatever ``labels`` says of them.
    """
    trusted = labels.filter(learn & (F.col(label) == 1)).select(key, F.lit(1).alias("_kind"))
    trusted = with_text(trusted, docs, key, text)
    plain = docs.filter(learn & F.col(text).isNotNull()).select(key).join(trusted.select(key), key, "left_anti")
    sample = bounded_sample(trusted.unionByName(plain.select(key, F.lit(0).alias("_kind"))), docs, key, text, "_kind")
    positive, unlabelled = (list(sample["text"][sample["label"] == kind]) for kind in (1, 0))
    if len(positive) < 4:
        return 0.0
    if len(unlabelled) < 4:
        return 1.0
    return fit(positive, unlabelled)[0]


def score(docs: DataFrame, text: str, model: Network | float, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a column ``name``."""
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.probability(describe_all(batch)) if len(batch) else np.zeros(0))

    return docs.withColumn(name, probability(F.col(text)))
