"""Embedding whitening by principal components.

The vectors become integers, so that the counts and sums over the fit list (each distinct
vector once) are exact. Tasks add up the products of centred vectors, d * d numbers for each
task whatever the rows, and Spark sums them. The driver holds this one matrix: Householder
reflections make it tridiagonal, Sturm counts bisect its leading eigenvalues, inverse
iteration finds their vectors, which are made orthogonal within clusters of near
eigenvalues, and the reflections turn them back. The components, d * 16 numbers, go to all
tasks, which project their vectors.

Defined cases: vectors that are null, empty or hold a null, NaN or infinite entry are left out.
Of differing lengths the most frequent counts (of equally frequent ones the longest), other rows
are left out. Entries of more than 2**40 steps are held there. A deviation that no
long holds is null. Components without variance (as with one distinct vector, or repeated
dimensions) have no rows, since nothing can be divided by their deviation. Null and
repeated ids keep their rows; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
MOST_STEPS = 2.0**40
LONG = (1 << 63) - 1


class Whitening(NamedTuple):
    """Of the fit list: rows, exact sums, components (one a row), eigenvalues, trace of the covariance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float


def integers(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Rows (_key, _x) with ``_x`` the integer vector, of the vectors that are whole."""
    entry = F.col(vector)
    whole = F.forall(entry, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    step = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(MOST_STEPS)), F.lit(-MOST_STEPS)))
    found = df.filter(entry.isNotNull() & (F.size(entry) > 0) & whole).select(
        F.col(key).alias("_key"), F.transform(entry, lambda c: step(c).cast("long") + OFFSET).alias("_x")
    )
    lengths = found.groupBy(F.size("_x").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    usual = lengths.orderBy(F.desc("_n"), F.desc("_d")).first()
    return found.filter(F.size("_x") == (usual["_d"] if usual else 0))


def _rows(part: pd.DataFrame) -> np.ndarray:
    return np.stack([np.asarray(x, np.int64) for x in part["_x"]])


def _summed(df: DataFrame, of_part: Callable[[pd.DataFrame], np.ndarray], kind: str) -> np.ndarray:
    """Sum over all rows of the vectors that ``of_part`` gives: one partial vector a task, added up by Spark."""

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for part in parts:
            if len(part):
                found = of_part(part)
                total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"at": np.arange(len(total)), "v": total})

    added = df.mapInPandas(partial, f"at long, v {kind}").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at")
    return np.array([r["v"] for r in added.collect()])


def covariance(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """Of the column ``_x``, centred before multiplying; only the upper triangle is sent."""
    mean, upper = sums / n, np.triu_indices(len(sums))

    def products(part: pd.DataFrame) -> np.ndarray:
        y = _rows(part) - mean
        return (y.T @ y)[upper]

    out = np.zeros((len(sums), len(sums)))
    out[upper] = _summed(fit, products, "double") / n
    return out + np.triu(out, 1).T


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors (unit vectors, or zeros for none) of a symmetric matrix."""
    a, d, reflectors = a.astype(float).copy(), len(a), []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        v = np.zeros(d)
        if np.any(x[1:]):
            x[0] += np.copysign(norm, x[0])
            v[k + 1 :] = x / np.linalg.norm(x)
            p = a @ v
            w = p - (v @ p) * v
            a -= 2 * (np.outer(v, w) + np.outer(w, v))
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues are less than each of ``x``."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q, count = diagonal[0] - x, np.zeros(len(x), int)
    for i in range(len(diagonal)):
        if i:
            q = diagonal[i] - x - off[i - 1] ** 2 / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    d = len(diagonal)
    around = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(wanted, (diagonal - around).min())
    high = np.full(wanted, (diagonal + around).max())
    high += np.spacing(np.abs(high)) + 1e-300
    place = d - np.arange(wanted)  # as many eigenvalues lie below what is above the wanted one
    for _ in range(2000):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        over = below(diagonal, off, middle) >= place
        high, low = np.where(over, middle, high), np.where(over, low, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, tiny: float, right: np.ndarray) -> np.ndarray:
    """Solution of (T - shift) x = right by elimination with row exchanges; a zero pivot counts as ``tiny``."""
    d = len(diagonal)
    a, b, c = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    lower, x = off.copy(), right.copy()
    for i in range(d - 1):
        if abs(lower[i]) > abs(a[i]):
            a[i], b[i], c[i], below_row = lower[i], a[i + 1], b[i + 1], (a[i], b[i], c[i])
            x[i], x[i + 1] = x[i + 1], x[i]
            factor = below_row[0] / a[i]
            a[i + 1], b[i + 1] = below_row[1] - factor * b[i], below_row[2] - factor * c[i]
        else:
            if abs(a[i]) < tiny:
                a[i] = tiny
            factor = lower[i] / a[i]
            a[i + 1] -= factor * b[i]
        x[i + 1] -= factor * x[i]
    if abs(a[-1]) < tiny:
        a[-1] = tiny
    for i in range(d - 1, -1, -1):
        later = (b[i] * x[i + 1] if i + 1 < d else 0.0) + (c[i] * x[i + 2] if i + 2 < d else 0.0)
        x[i] = (x[i] - later) / a[i]
        if abs(x[i]) > 1e150:  # the size of a solution doesn't matter
            x /= abs(x[i])
    return x


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one a row, by inverse iteration; near eigenvalues get orthogonal ones."""
    d, state = len(diagonal), np.random.default_rng(3)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0), np.finfo(float).tiny)
    eps = np.finfo(float).eps * norm
    found = np.zeros((len(values), d))
    start, shift = 0, 0.0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            start = k
        # equal eigenvalues get shifts a little apart
        shift = min(value, shift - eps) if k > start else value
        v = state.standard_normal(d)
        for _ in range(5):
            v = _solve(diagonal, off, shift, eps, v / np.linalg.norm(v))
            for _ in range(2):
                v -= found[start:k].T @ (found[start:k] @ v)
        found[k] = v / np.linalg.norm(v)
    return found


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors, one a row, of a symmetric matrix."""
    wanted = min(wanted, len(matrix))
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, wanted)
    vectors = leading_vectors(diagonal, off, values)
    for v in reversed(reflectors):
        vectors -= 2 * np.outer(vectors @ v, v)
    return values, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def train(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Of a table of distinct vectors ``_x``; None if it is empty. Read twice."""
    count_and_sums = _summed(fit, lambda part: np.append(_rows(part).sum(axis=0), len(part)), "long")
    if not len(count_and_sums):
        return None
    n, sums = int(count_and_sums[-1]), count_and_sums[:-1].astype(np.int64)
    v = covariance(fit, n, sums)
    values, vectors = leading_pairs(v, components)
    real = values > len(v) * np.finfo(float).eps * max(values[0], 0.0)
    return Whitening(n, sums, vectors[real], values[real], float(np.trace(v)))


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return (x - model.sums / model.n) @ (model.components / np.sqrt(model.values)[:, None]).T


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    total = _summed(fit, lambda part: _whitened(_rows(part), model).sum(axis=0), "double")
    mean = total / model.n

    def products(part: pd.DataFrame) -> np.ndarray:
        y = _whitened(_rows(part), model) - mean
        return (y.T @ y).ravel()

    found = _summed(fit, products, "double").reshape(k, k) / model.n
    return float(np.abs(found - np.eye(k)).max())


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Exact sums of (n * x - S) ** 2; null where they exceed a long."""
    most = np.abs(x).max(initial=0)
    if int(most) * model.n + int(np.abs(model.sums).max()) < LONG // 2:
        y = model.n * x - model.sums
        rough = (y.astype(float) ** 2).sum(axis=1)
        exact = (y * y).sum(axis=1)  # of no meaning where the sum is too large
        sure = rough < LONG * 0.999
        if sure.all():
            return exact.tolist()
    sums, out = [int(s) for s in model.sums], []
    for row in x:
        total = sum((model.n * int(c) - s) ** 2 for c, s in zip(row, sums))
        out.append(total if total <= LONG else None)
    return out


def whiten(df: DataFrame, key: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """Rows (key, component, n, deviation, whitened, explained, identity_error) of every whole vector."""
    rows = integers(df, key, vector)
    kind = rows.schema["_key"].dataType.simpleString()
    fit = materialize(rows.select("_x").distinct(), "fit-list")
    model = train(fit, components)
    if model is None or not len(model.values):
        shares, error = [], 0.0
    else:
        shares, error = (model.values / model.trace).tolist(), identity_error(fit, model)
    release(fit)

    def project(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                x = _rows(part)
                yield pd.DataFrame(
                    {
                        "_key": part["_key"],
                        "deviation": pd.array(_deviations(x, model), "Int64"),
                        "_whitened": list(_whitened(x, model)),
                    }
                )

    if not shares:
        rows = rows.limit(0)
    projected = rows.mapInPandas(project, f"_key {kind}, deviation long, _whitened array<double>")
    by_component = F.array(*[F.lit(s) for s in shares]) if shares else F.array().cast("array<double>")
    spread = projected.select("_key", "deviation", F.posexplode("_whitened").alias("_at", "whitened"))
    return spread.select(
        F.col("_key").alias(key),
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(by_component, "_at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
