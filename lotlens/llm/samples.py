"""Bounded training samples, the only rows of a corpus that the driver ever holds."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.profile import sample_rows
from ..session import materialize, release

FULL_CLASSES = 50  # more classes share the rows and characters of so many
SEED = 5
ROWS_PER_CLASS = 3000
CHARS_PER_CLASS = 12_000_000


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def with_text(marked: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``marked`` whose document is there with a text, so that a sample of them is full."""
    there = docs.filter(F.col(text).isNotNull()).select(F.col(key).alias("_there"))
    return marked.join(there, F.col(key) == F.col("_there"), "left_semi")


def bounded_sample(
    marked: DataFrame,
    docs: DataFrame,
    key: str,
    text: str,
    label: str,
    rows: int = ROWS_PER_CLASS,
    chars: int = CHARS_PER_CLASS,
) -> pd.DataFrame:
    """At most ``rows`` texts and ``chars`` characters of each class of ``marked`` (key, label).

    Every class is sampled. Beyond FULL_CLASSES classes, ``rows`` and ``chars`` shrink so
    that all classes together take no more, but for one text that each class has at least:
    the shortest in its sample, if none fits.

    The rows have the smallest hashes of their key, so that the sample is the same on
    every run. A text that would exceed the remaining characters is passed over;
    texts are whole. Keys are taken once; of texts under one key the least is taken.
    Null keys, labels and texts are left out.

    Keys and the chosen ones are written, so that the driver plans and follows the work
    on ``marked`` once and not in each of the jobs below.
    """
    known = materialize(
        marked.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_id"))
        .agg(F.max(label).alias("_label")),
        "labelled-keys",
    )
    stored = [known]
    try:
        classes = known.agg(F.count_distinct("_label")).first()[0]
        if not classes:
            return pd.DataFrame({"label": [], "text": []})
        if classes > FULL_CLASSES:
            rows, chars = max(1, FULL_CLASSES * rows // classes), max(1, FULL_CLASSES * chars // classes)
        chosen = materialize(sample_rows(known, rows, SEED, "_id", ["_label"]), "chosen-keys")
        stored.append(chosen)
        return _texts_of(chosen, docs, key, text, chars)
    finally:
        release(*stored)


def _texts_of(chosen: DataFrame, docs: DataFrame, key: str, text: str, chars: int) -> pd.DataFrame:
    """Labels and texts of the ``chosen`` keys (_id, _label), as far as ``chars`` of each class reach."""
    texts = (
        docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
        .filter("_text is not null")
        .join(F.broadcast(chosen), "_id")  # at most ``rows`` ids a class, of FULL_CLASSES classes in sum
    )
    sizes = texts.groupBy("_id", "_label").agg(F.min(F.char_length("_text")).alias("n")).toPandas()
    kept = []
    for _, part in sizes.sort_values("_id").groupby("_label"):
        total, before = 0, len(kept)
        for one, n in zip(part["_id"], part["n"]):
            if total + n <= chars:
                total += n
                kept.append(int(one))
        if len(kept) == before:
            kept.append(int(part["_id"].iloc[part["n"].argmin()]))
    if not kept:
        return pd.DataFrame({"label": [], "text": []})
    ids = docs.sparkSession.createDataFrame([(i,) for i in kept], "_id long")
    least = F.min(F.struct(F.char_length("_text").alias("n"), F.col("_text").alias("t")))["t"]
    found = texts.join(F.broadcast(ids), "_id").groupBy("_id", "_label").agg(least.alias("text"))
    return found.toPandas().sort_values("_id").rename(columns={"_label": "label"})[["label", "text"]]
