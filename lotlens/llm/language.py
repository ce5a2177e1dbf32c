"""Language of web pages by Bayesian evidence fusion.

Four kinds of evidence are multiplied: the likelihood of the page's text under
character n-gram models, the language that the markup declares, the language that the
address names (its country suffix or a path part), and a prior of the host.

* The n-gram models are fitted on a bounded sample of labelled texts.
* How far declarations and addresses can be trusted is counted over all pages, with the
  text's own verdict as the reference.
* Host priors are sums of the text's verdicts over all pages of the host, smoothed
  towards the registered domain, which is smoothed towards the whole corpus. A page's
  own verdict is left out of its prior.

Defined cases: a page without text, markup or address has the other evidence only, and
in the end the corpus prior; null columns count as empty; repeated rows are each
judged; without labelled texts the language is null; of equally likely languages the
first code in order is taken; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .samples import bounded_sample
from .url_filter import host_of, path_of

BUCKETS, ORDERS = 1 << 16, (1, 2, 3)
SMOOTHING = 0.5
EVIDENCE = 40.0  # n-grams overlap: a text counts as at most so many independent ones
HOST_WEIGHT, DOMAIN_WEIGHT = 5.0, 20.0  # pages that the wider prior is worth
ROWS_PER_LANGUAGE, CHARS_PER_LANGUAGE = 500, 2_000_000

_HIDDEN = re.compile(r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^<>]*>")
_DECLARED = r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b"


def visible_text(page: str | None) -> str:
    return entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page))) if page else ""


def grams(text: str) -> np.ndarray:
    """Hashed n-grams of the bytes of the small letters of ``text``; other signs are blanks."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else text.lower()
    data = np.frombuffer(f" {' '.join(kept.split())} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(data) <= 2:
        return np.zeros(0, np.int64)
    found, rolling = [], None
    for n in range(1, max(ORDERS) + 1):
        rolling = data if n == 1 else rolling[:-1] * np.uint32(0x01000193) + data[n - 1 :]
        if n in ORDERS:
            hashed = (rolling + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            found.append((hashed >> np.uint32(16)).astype(np.int64) % BUCKETS)
    return np.concatenate(found)


@dataclass
class TextModel:
    languages: list[str]
    logs: np.ndarray  # n-gram bucket by language

    def posterior(self, text: str) -> np.ndarray:
        """Probabilities under equal priors; all equal for a text without letters."""
        ids = grams(text)
        if not len(ids):
            return np.full(len(self.languages), 1 / len(self.languages))
        score = self.logs[ids].mean(0) * min(float(len(ids)), EVIDENCE)
        odds = np.exp(score - score.max())
        return odds / odds.sum()


def fit(texts: list[str], languages: list[str]) -> TextModel | None:
    names = sorted(set(languages))
    if not names:
        return None
    counts = np.full((BUCKETS, len(names)), SMOOTHING)
    for text, language in zip(texts, languages):
        counts[:, names.index(language)] += np.bincount(grams(text), minlength=BUCKETS)
    return TextModel(names, np.log(counts / counts.sum(0)).astype(np.float32))


def train(docs: DataFrame, key: str, text: str, language: str) -> TextModel | None:
    marked = docs.select(key, language)
    sample = bounded_sample(marked, docs, key, text, language, ROWS_PER_LANGUAGE, CHARS_PER_LANGUAGE)
    return fit(list(sample["text"]), list(sample["label"]))


def text_verdicts(model: TextModel, page: Column) -> Column:
    @F.pandas_udf("array<double>")
    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.posterior(visible_text(p)) for p in batch], dtype=object)

    return verdicts(page)


def named_language(host: Column, path: Column, languages: list[str]) -> Column:
    """A language code as country suffix or as first path part; empty without any."""
    first = F.lower(F.regexp_extract(path, r"^/([A-Za-z]{2,3})(?:[-_][A-Za-z]+)?(?:/|$)", 1))
    suffix = F.regexp_extract(host, r"\.([a-z]{2,3})(?::\d+)?$", 1)
    return F.when(first.isin(languages), first).when(suffix.isin(languages), suffix).otherwise(F.lit(""))


def _sums(languages: list[str]) -> list[Column]:
    return [F.sum(F.col("verdict")[i]).alias(f"s{i}") for i in range(len(languages))]


def _share(n: int) -> list[Column]:
    total = sum((F.col(f"s{i}") for i in range(n)), F.lit(0.0))
    return [F.col(f"s{i}") / total for i in range(n)]


def _trust(pages: DataFrame, said: str, languages: list[str]) -> DataFrame:
    """For each value of ``said``, the log likelihood of it under every language, as an array."""
    n = len(languages)
    by_value = pages.groupBy(said).agg(*_sums(languages))
    # at most one row per language code and one for none; other codes count as none
    total = by_value.agg(*[F.sum(f"s{i}").alias(f"t{i}") for i in range(n)]).first()
    logs = F.array(*[F.log((F.col(f"s{i}") + SMOOTHING) / F.lit(float(total[i] or 0) + SMOOTHING * (n + 1))) for i in range(n)])
    return by_value.select(said, logs.alias(f"{said}_logs"))


def identify(pages: DataFrame, key: str, url: str, page: str, model: TextModel | None) -> DataFrame:
    """One row per page: language, probability, and what each kind of evidence says."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    if model is None:
        empty = F.lit(None).cast("string")
        return pages.select(F.col(key), host.alias("host"), empty.alias("lang"), F.lit(None).cast("double").alias("probability"), empty.alias("text_lang"), empty.alias("declared"), empty.alias("address"))
    names, n = model.languages, len(model.languages)
    declared = F.lower(F.regexp_extract(F.coalesce(F.col(page), F.lit("")), _DECLARED, 1))
    judged = materialize(
        pages.select(
            F.col(key).alias("_key"),
            host.alias("host"),
            F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1).alias("domain"),
            F.when(declared.isin(names), declared).otherwise(F.lit("")).alias("declared"),
            named_language(host, path, names).alias("address"),
            text_verdicts(model, F.col(page)).alias("verdict"),
        ),
        "verdicts",
    )
    corpus = judged.agg(*_sums(names)).first()
    mass = float(sum(x or 0 for x in corpus)) + n
    whole = [(float(x or 0) + 1) / mass for x in corpus]
    domains = judged.groupBy("domain").agg(*_sums(names))
    total = sum((F.col(f"s{i}") for i in range(n)), F.lit(0.0))
    domains = domains.select(
        "domain",
        F.array(*[(F.col(f"s{i}") + DOMAIN_WEIGHT * whole[i]) / (total + DOMAIN_WEIGHT) for i in range(n)]).alias("wider"),
    )
    hosts = judged.groupBy("domain", "host").agg(*_sums(names)).join(domains, "domain")
    hosts = hosts.select("host", "wider", F.array(*[F.col(f"s{i}") for i in range(n)]).alias("held"))
    joined = judged.join(hosts, "host")
    for said in ("declared", "address"):
        joined = joined.join(_trust(judged, said, names), said)

    def evidence(i: int) -> Column:
        others = F.greatest(F.col("held")[i] - F.col("verdict")[i], F.lit(0.0))
        # the page's own verdict is left out of what the host says
        rest = F.greatest(F.aggregate("held", F.lit(0.0), lambda a, x: a + x) - 1, F.lit(0.0))
        prior = (others + HOST_WEIGHT * F.col("wider")[i]) / (rest + HOST_WEIGHT)
        return (
            F.log(F.greatest(F.col("verdict")[i], F.lit(1e-12)))
            + F.log(prior)
            + F.col("declared_logs")[i]
            + F.col("address_logs")[i]
        )

    scored = joined.withColumn("_log", F.array(*[evidence(i) for i in range(n)]))
    best = F.array_position("_log", F.array_max("_log")).cast("int")
    odds = F.aggregate("_log", F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max("_log")))
    codes = F.array(*map(F.lit, names))
    return scored.select(
        F.col("_key").alias(key),
        "host",
        F.element_at(codes, best).alias("lang"),
        (1 / odds).alias("probability"),
        F.element_at(codes, F.array_position("verdict", F.array_max("verdict")).cast("int")).alias("text_lang"),
        "declared",
        "address",
    )
