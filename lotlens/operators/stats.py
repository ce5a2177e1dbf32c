"""Poisson rate model with robust (HC0) errors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import one_row

INTERCEPT = "Intercept"


class Fit(NamedTuple):
    terms: list[str]
    names: list[str]  # columns of the design, in the order of the terms
    design: DataFrame  # y, offset and the columns
    beta: np.ndarray


@contextmanager
def poisson_fit(
    df: DataFrame,
    y: str,
    covariates: Sequence[str],
    category: str,
    levels: Sequence[str],
    offset: str,
) -> Iterator[Fit]:
    """A log-link Poisson model; its rows stay cached within the block.

    ``levels[0]`` is the base of the category. Rows with a missing input are dropped.
    """
    dummies = {f"{category}[{level}]": F.col(category) == level for level in levels[1:]}
    terms = [INTERCEPT, *covariates, *dummies]
    inputs = df.dropna(subset=[y, *covariates, category, offset])
    design = inputs.select(
        F.col(y).cast("double").alias("y"),
        F.col(offset).cast("double").alias("offset"),
        F.lit(1.0).alias("x0"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(covariates, 1)],
        *[
            cond.cast("double").alias(f"x{i}")
            for i, cond in enumerate(dummies.values(), 1 + len(covariates))
        ],
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        names = [f"x{i}" for i in range(len(terms))]
        features = VectorAssembler(inputCols=names[1:], outputCol="features").transform(design)
        model = GeneralizedLinearRegression(
            family="poisson", link="log", labelCol="y", offsetCol="offset", tol=1e-10, maxIter=50
        ).fit(features)
        yield Fit(terms, names, design, np.array([model.intercept, *model.coefficients]))
    finally:
        design.unpersist()


def poisson_rates(df: DataFrame, *model, **options) -> DataFrame:
    """Rate ratios ``exp(b)`` with 95 % limits and p-values; arguments as of ``poisson_fit``.

    The robust covariance is one aggregation over the cached rows, so only p x p sums
    reach the driver.
    """
    with poisson_fit(df, *model, **options) as fit:
        cov = _robust_covariance(fit.design, fit.names, fit.beta)
    return df.sparkSession.createDataFrame(
        _ratios(fit.terms, fit.beta, np.sqrt(np.diag(cov))),
        "term string, rate_ratio double, low_95 double, high_95 double, p_value double",
    )


def poisson_totals(df: DataFrame, *model, **options) -> DataFrame:
    """Per term, the sum of the term times the fitted mean over all rows.

    At the maximum of the likelihood it equals the sum of the term times what was
    observed, which holds for no other coefficients.
    """
    with poisson_fit(df, *model, **options) as fit:
        fitted = _with_means(fit.design, fit.names, fit.beta)
        row = fitted.agg(*[F.sum(F.col("mu") * F.col(n)).alias(n) for n in fit.names]).first()
    totals = [(term, row[name]) for term, name in zip(fit.terms, fit.names, strict=True)]
    return df.sparkSession.createDataFrame(totals, "term string, total double")


def _with_means(design: DataFrame, names: Sequence[str], beta: np.ndarray) -> DataFrame:
    eta: Column = F.col("offset")
    for name, b in zip(names, beta, strict=True):
        eta = eta + F.col(name) * float(b)
    return design.withColumn("mu", F.exp(eta))


def _robust_covariance(design: DataFrame, names: Sequence[str], beta: np.ndarray) -> np.ndarray:
    """Inverse(A) B inverse(A), with A = sum(mu x x') and B = sum((y - mu)^2 x x')."""
    fitted = _with_means(design, names, beta)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    squared = F.pow(F.col("y") - F.col("mu"), 2)
    sums = []
    for i, j in pairs:
        product = F.col(names[i]) * F.col(names[j])
        sums.append(F.sum(F.col("mu") * product).alias(f"a{i}_{j}"))
        sums.append(F.sum(squared * product).alias(f"b{i}_{j}"))
    row = fitted.agg(*sums).first()
    a, b = (np.empty((len(names), len(names))) for _ in range(2))
    for i, j in pairs:
        a[i, j] = a[j, i] = row[f"a{i}_{j}"]
        b[i, j] = b[j, i] = row[f"b{i}_{j}"]
    bread = np.linalg.inv(a)
    return bread @ b @ bread


def _ratios(terms: Sequence[str], beta: np.ndarray, se: np.ndarray) -> list[tuple]:
    out = []
    for term, b, s in zip(terms, beta, se, strict=True):
        p = math.erfc(abs(b / s) / math.sqrt(2))
        low, high = math.exp(b - 1.959963984540054 * s), math.exp(b + 1.959963984540054 * s)
        out.append((term, math.exp(b), low, high, p))
    return out


def category_rate_ratios(df: DataFrame, y: str, category: str, base: str, area: str) -> DataFrame:
    """The model with the category only: then it is saturated and needs no iteration.

    The ratio is that of the pooled rates; ``se`` is the robust standard error
    of its logarithm.
    """
    known = df.dropna(subset=[y, category, area])
    sums = known.groupBy(category).agg(
        F.sum(y).alias("n"),
        F.sum(area).alias("area"),
        F.sum(F.col(y) * F.col(y)).alias("yy"),
        F.sum(F.col(y) * F.col(area)).alias("ya"),
        F.sum(F.col(area) * F.col(area)).alias("aa"),
    )
    rate = F.col("n") / F.col("area")
    # sum((y - rate * area)^2) / n^2
    spread = F.col("yy") - 2 * rate * F.col("ya") + rate * rate * F.col("aa")
    rated = sums.filter(F.col("n") > 0).select(
        category, rate.alias("rate"), (spread / (F.col("n") * F.col("n"))).alias("var")
    )
    reference = rated.filter(F.col(category) == base).select(
        F.col("rate").alias("base_rate"), F.col("var").alias("base_var")
    )
    others = rated.filter(F.col(category) != base)
    return one_row(others, reference).select(
        category,
        F.round(F.col("rate") / F.col("base_rate"), 4).alias("rate_ratio"),
        F.round(F.sqrt(F.col("var") + F.col("base_var")), 4).alias("se"),
    )
