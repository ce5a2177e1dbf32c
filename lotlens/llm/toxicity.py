"""Toxicity by subword-bag embeddings.

A word is the bag of its hashed character n-grams and of itself; a text is the mean
of the vectors of all its words' features, followed by a linear softmax. Vectors and
softmax are trained together in numpy on a bounded sample. A misspelt word that was
never seen still shares most n-grams with the known one.

The softmax is linear, so the difference of its two logits can be taken for each
feature before averaging: executors get one number per feature, and a word's sum is
computed once per task.

Defined cases: a null or wordless text gets the score that the bias alone gives; a
label given twice counts as its greatest value; without labels of both classes every
text gets the share of the positive ones (0 without any); repeated rows are each
scored; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .samples import bounded_sample, with_text

BUCKETS, DIMENSIONS = 1 << 18, 8
SHORTEST, LONGEST = 3, 5
EPOCHS, UPDATES, BATCH, RATE, PATIENCE = 10, 300, 64, 0.4, 3  # at least so many epochs and updates
CALIBRATION = 5
STRETCH = 48  # words in a training stretch of a clean text, at most
CHUNK = 500_000  # characters whose words are looked up together
WORDS_AT_ONCE = 5_000  # words of the sample that are cut up together, on the driver
KNOWN_WORDS = 300_000  # words whose sums a task remembers at once
TRIM = ".,;:!?\"'()[]"


def words_of(text: str) -> list[str]:
    return text.lower().split()


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, one word after the other, and how many each word has."""
    raw = [f"<{w.strip(TRIM) or w}>" for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in raw), np.uint32, len(raw))
    # one number a character: a gram never cuts a letter in two
    data = np.frombuffer("".join(raw).encode("utf-32-le", "replace"), np.uint32)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(raw)), lengths)
    room = np.repeat(ends, lengths) - np.arange(len(data))
    features, owners = [whole], [np.arange(len(raw))]
    rolling = data.copy()
    for n in range(2, LONGEST + 1):
        rolling = rolling[:-1] * np.uint32(0x01000193) + data[n - 1 :]
        if n >= SHORTEST:
            fits = room[: len(rolling)] >= n
            hashed = rolling[fits] * np.uint32(0x9E3779B1)
            features.append(hashed ^ (hashed >> np.uint32(15)) ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF))
            owners.append(owner[: len(rolling)][fits])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    numbers = (np.concatenate(features)[order] % np.uint32(BUCKETS)).astype(np.int64)
    return numbers, np.bincount(owners, minlength=len(raw))


@dataclass
class Model:
    weights: np.ndarray  # per feature, the difference of the two logits
    bias: float

    def probability(self, means: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(means + self.bias, -50, 50)))


def constant(share: float) -> Model:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of several runs, one after the other."""
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - np.repeat(before - starts, counts)


def _calibrate(margin: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by Platt's method, at ``share`` of label 1."""
    ones, zeros = int(labels.sum()), int(len(labels) - labels.sum())
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    weight = np.where(labels == 1, share / ones, (1 - share) / zeros) * len(labels)
    x, line = np.stack([margin, np.ones_like(margin)], 1), np.array([1.0, 0.0])
    ridge = np.diag([1e-3, 1e-3]) * len(labels)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -50, 50)))
        slope = x.T @ (weight * (p - target)) + ridge @ (line - [1.0, 0.0])
        line = line - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
        line = np.clip(line, [0.2, -50], [20, 50])
    return float(line[0]), float(line[1])


def fit(texts: list[str], labels: np.ndarray, share: float, seed: int = 7) -> Model:
    """Train embeddings and softmax; ``share`` is the share of label 1 in the whole corpus.

    Every CALIBRATION-th text of the sample is kept back and tells how margins translate
    into probabilities; then all texts train the vectors that are used.
    """
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        return constant(share)
    share = min(max(share, 1e-4), 1 - 1e-4)
    held = np.zeros(len(labels), bool)
    for label in (0, 1):
        held[np.flatnonzero(labels == label)[CALIBRATION - 1 :: CALIBRATION]] = True
    learnt = _embed([t for t, h in zip(texts, held) if not h], labels[~held], seed)
    if len(set(labels[held].tolist())) < 2:
        return Model(learnt.weights, learnt.bias + float(np.log(share / (1 - share))))
    (means,) = mean_weights(learnt, iter([pd.Series([t for t, h in zip(texts, held) if h])]))
    slope, offset = _calibrate(means + learnt.bias, labels[held], share)
    learnt = _embed(texts, labels, seed)
    return Model((learnt.weights * slope).astype(np.float32), learnt.bias * slope + offset)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``subwords``, in little memory: the numbers are kept small, and few words are cut up at a time."""
    features, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, len(words), WORDS_AT_ONCE):
        numbers, counts = subwords(words[i : i + WORDS_AT_ONCE])
        features.append(numbers.astype(np.int32))
        sizes.append(counts)
    return np.concatenate(features), np.concatenate(sizes)


def _embed(texts: list[str], labels: np.ndarray, seed: int) -> Model:
    """Embeddings and softmax trained together, both classes weighed alike."""
    index: dict[str, int] = {}
    bags = []
    for text in texts:
        bags.append(np.array([index.setdefault(w, len(index)) for w in words_of(text)], np.int32))
    features, sizes = _features(list(index))
    del index
    starts = np.cumsum(sizes) - sizes
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    grown, grown_softmax, grown_bias = None, np.full_like(softmax, 1e-8), np.full_like(bias, 1e-8)
    trainable = [i for i, ids in enumerate(bags) if len(ids)]
    batches = max(1, len(trainable) // BATCH)
    for _ in range(max(EPOCHS, -(-UPDATES // batches)) if trainable else 0):
        # any stretch of a clean text is clean too: short ones keep common words near zero
        chosen = [(bags[i], labels[i]) for i in trainable]
        for i in trainable:
            if labels[i] == 0:
                length = int(STRETCH ** rng.random())  # as often 1 to 2 words as 24 to 48
                start = int(rng.integers(0, max(1, len(bags[i]) - length + 1)))
                chosen.append((bags[i][start : start + length], 0))
        order = rng.permutation(len(chosen))
        ones = np.mean([y for _, y in chosen])
        for part in np.array_split(order, max(1, len(order) // BATCH)):
            targets = np.array([chosen[i][1] for i in part])
            ids = np.concatenate([chosen[i][0] for i in part])
            times = np.ones(len(ids), np.float32)
            doc = np.repeat(np.arange(len(part)), [len(chosen[i][0]) for i in part])
            words, place = np.unique(ids, return_inverse=True)
            used = features[_gather(starts[words], sizes[words])]
            firsts = np.cumsum(sizes[words]) - sizes[words]
            word_vectors = np.add.reduceat(vectors[used], firsts, axis=0)
            length = np.bincount(doc, times * sizes[ids], minlength=len(part)).astype(np.float32)
            share_of_doc = times / length[doc]
            doc_firsts = np.searchsorted(doc, np.arange(len(part)))
            means = np.add.reduceat(word_vectors[place] * share_of_doc[:, None], doc_firsts, axis=0)
            logits = means @ softmax + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            wrong = odds / odds.sum(1, keepdims=True)
            wrong[np.arange(len(part)), targets] -= 1
            wrong *= (np.where(targets == 1, 0.5 / ones, 0.5 / (1 - ones)) / len(part))[:, None]
            back = (wrong @ softmax.T)[doc] * share_of_doc[:, None]
            slope = np.empty_like(vectors)
            for d in range(DIMENSIONS):
                to_words = np.bincount(place, back[:, d], minlength=len(words))
                slope[:, d] = np.bincount(used, np.repeat(to_words, sizes[words]), minlength=BUCKETS)
            if grown is None:
                # a feature has to be pushed often before it moves freely: words of one text alone stay put
                start = (PATIENCE * np.sqrt((slope[used] ** 2).mean())) ** 2
                grown = np.full_like(vectors, start)
            for value, total, step in (
                (vectors, grown, slope),
                (softmax, grown_softmax, means.T @ wrong),
                (bias, grown_bias, wrong.sum(0)),
            ):
                total += step * step
                value -= RATE * step / np.sqrt(total)
    direction = softmax[:, 1] - softmax[:, 0]
    return Model((vectors @ direction).astype(np.float32), float(bias[1] - bias[0]))


def _chunks(texts: pd.Series) -> Iterator[list[str]]:
    """Texts in order, in lists of about CHUNK characters."""
    part, held = [], 0
    for text in texts:
        part.append(text or "")
        held += len(part[-1])
        if held >= CHUNK:
            yield part
            part, held = [], 0
    yield part


def mean_weights(model: Model, batches: Iterator[pd.Series]) -> Iterator[np.ndarray]:
    """Per text, the mean of its features' weights; 0 without words."""
    index: dict[str, int] = {}
    sums, counts = np.zeros(0), np.zeros(0)
    for batch in batches:
        means = []
        for part in _chunks(batch):
            if len(index) > KNOWN_WORDS:
                index, sums, counts = {}, np.zeros(0), np.zeros(0)
            worded = [words_of(text) for text in part]
            fresh = [w for w in set().union(*worded) if w not in index]
            if fresh:
                features, sizes = subwords(fresh)
                firsts = np.cumsum(sizes) - sizes
                sums = np.concatenate([sums, np.add.reduceat(model.weights[features], firsts)])
                counts = np.concatenate([counts, sizes])
                index.update(zip(fresh, range(len(index), len(index) + len(fresh))))
            for words in worded:
                at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                means.append(sums[at].sum() / counts[at].sum() if words else 0.0)
        yield np.array(means, float)


def score_batches(model: Model, batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for means in mean_weights(model, batches):
        yield pd.Series(model.probability(means))


def scorer(model: Model) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return score_batches(model, batches)

    return score


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, learn: Column) -> Model:
    """A model from a bounded sample of the rows of ``labels`` (key, label) where ``learn`` holds.

    Only labels of documents with a text count.
    """
    marked = with_text(labels.filter(learn).select(key, label), docs, key, text)
    share = marked.agg(F.avg(F.col(label).cast("double"))).first()[0]
    sample = bounded_sample(marked, docs, key, text, label)
    return fit(list(sample["text"]), sample["label"].to_numpy(), share or 0.0)


def score(docs: DataFrame, text: str, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in a column ``name``."""
    return docs.withColumn(name, scorer(model)(F.col(text)))
