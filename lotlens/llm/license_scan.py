"""License scans by diagonal voting over rolling word k-grams.

All k-grams of a text are joined by hash, and checked by their words, with the
positions at which license templates hold them. A hit votes for the diagonal
``position in the text - position in the template``. Votes are kept as bit sets of
template positions, as many as a template's length takes. Neighbouring diagonals, which a few
inserted or missing words cause, are merged if their hits are close. A merged span is
verified by the share of the template's k-grams that it holds.

A base phrase counts where its words stand consecutively: where one diagonal holds
all of its k-grams.

Templates have any length and come as literal rows or as a table. Their k-grams are written
first: a list that is small is broadcast, a larger one is joined by shuffles.

Defined cases: a template without words is ignored, one shorter than a k-gram is an error; a null or empty text has no words, no labels and score 0; repeated
rows are each scanned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import ascii_lower, small_table, split_words

K = 2  # words in a k-gram: the shortest phrase has two
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
SLOT = 63  # template positions in one bit set

#: The contract's phrases and labels, and well-known wordings of common licenses.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
WORDINGS = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("dedicated to the public domain", "public-domain"),
)


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def _gram(words: Column | str, at: Column, k: int) -> Column:
    """The ``k`` words from a place on, null where fewer are left."""
    return F.when(F.get(words, at + (k - 1)).isNotNull(), F.array(*[F.get(words, at + i) for i in range(k)]))


def templates_of(spark: SparkSession, base: Sequence[tuple], wordings: Sequence[tuple] | DataFrame) -> DataFrame:
    """Rows (template, text, label, is_base). Wordings are rows (text, label), or a table whose first two columns are these."""
    schema = "text string, label string"
    if not isinstance(wordings, DataFrame):
        wordings = small_table(spark, wordings, schema)
    text, label = wordings.columns[:2]
    theirs = wordings.select(F.col(text).alias("text"), F.col(label).alias("label"), F.lit(False).alias("is_base"))
    both = small_table(spark, base, schema).withColumn("is_base", F.lit(True)).unionByName(theirs)
    return both.filter("label is not null").select(F.monotonically_increasing_id().alias("template"), "*")


def template_grams(templates: DataFrame, k: int = K) -> DataFrame:
    """Rows (template, label, is_base, grams, t_at, t_gram, t_hash), one per k-gram of a template, stored."""
    worded = templates.withColumn("_words", words_of(F.col("text"))).filter(F.size("_words") > 0)
    short = worded.filter(F.size("_words") < k).select("text").first()
    if short:
        raise ValueError(f"a template needs {k} words: {short[0][:60]}")
    grams = (F.size("_words") - (k - 1)).alias("grams")
    spread = worded.select("template", "label", "is_base", grams, "_words", F.posexplode("_words").alias("t_at", "_word"))
    spread = spread.withColumn("t_gram", _gram("_words", F.col("t_at"), k)).filter("t_gram is not null")
    listed = spread.select("template", "label", "is_base", "grams", "t_at", "t_gram", F.xxhash64("t_gram").alias("t_hash"))
    return materialize(listed, "template-grams")


ABOUT = ["_row", "_key", "_n", "template", "label", "is_base", "grams"]


def hits(df: DataFrame, key: str, text: str, templates: DataFrame, k: int = K) -> DataFrame:
    """One row per text without a hit, and per text, template and diagonal with hits."""
    worded = df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), words_of(F.col(text)).alias("_words")
    )
    spread = worded.select(
        "_row", "_key", F.size("_words").alias("_n"), "_words", F.posexplode_outer("_words").alias("_at", "_word")
    )
    grams = spread.select("_row", "_key", "_n", "_at", _gram("_words", F.col("_at"), k).alias("_gram"))
    grams = grams.withColumn("_hash", F.when(F.col("_gram").isNotNull(), F.xxhash64("_gram")))
    same = (grams["_hash"] == templates["t_hash"]) & (grams["_gram"] == templates["t_gram"])
    here = F.when(F.col("t_at").isNotNull(), F.col("_at"))
    slots = (
        grams.join(templates, same, "left")
        .withColumns({"_diagonal": F.col("_at") - F.col("t_at"), "_slot": F.floor(F.col("t_at") / SLOT).cast("int")})
        .groupBy(*ABOUT, "_diagonal", "_slot")
        .agg(
            F.bit_or(F.expr(f"shiftleft(1L, t_at % {SLOT})")).alias("_bits"),
            F.min(here).alias("_first"),
            F.max(here).alias("_last"),
        )
    )
    return slots.groupBy(*ABOUT, "_diagonal").agg(
        F.collect_list(F.struct("_slot", "_bits")).alias("_slots"),
        F.sum(F.bit_count("_bits")).alias("_hits"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )


def merge_diagonals(found: DataFrame, gap: int) -> DataFrame:
    """Join neighbouring diagonals of a text and template whose hits lie side by side."""
    along = Window.partitionBy("_row", "template").orderBy("_diagonal")
    apart = (F.col("_diagonal") - F.lag("_diagonal").over(along) > gap) | (
        F.col("_first") - F.lag("_last").over(along) > F.col("grams")
    ) | (F.lag("_first").over(along) - F.col("_last") > F.col("grams"))
    marked = found.withColumn("_new", F.coalesce(apart, F.lit(True)).cast("int"))
    running = along.rowsBetween(Window.unboundedPreceding, 0)
    banded = marked.withColumn("_band", F.sum("_new").over(running))
    # a diagonal counts once, a template position once in its band
    spread = banded.select("*", F.posexplode_outer("_slots").alias("_pos", "_part"))
    whole = (F.col("_hits") == F.col("grams")) & (F.coalesce("_pos", F.lit(0)) == 0)
    slots = spread.groupBy(*ABOUT, "_band", F.col("_part._slot").alias("_slot")).agg(
        F.bit_or("_part._bits").alias("_bits"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        # places of a whole template, in a row of words without a gap
        F.count_if(whole).alias("_whole"),
        F.min(F.when(whole, F.col("_diagonal"))).alias("_start"),
        F.max(F.when(whole, F.col("_diagonal"))).alias("_end"),
    )
    return slots.groupBy(*ABOUT, "_band").agg(
        F.sum(F.bit_count("_bits")).alias("_held"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum("_whole").alias("_whole"),
        F.min("_start").alias("_start"),
        F.max("_end").alias("_end"),
    )


def scan(
    spark: SparkSession,
    df: DataFrame,
    key: str,
    text: str,
    *,
    base=BASE,
    wordings: Sequence[tuple] | DataFrame = WORDINGS,
    share: float = 0.75,
    gap: int = 2,
    k: int = K,
) -> DataFrame:
    """Labels of every row of ``df``, with the spans that gave them.

    ``wordings``: rows or a table (text, label) of license texts. ``share``: the part of a
    wording's k-grams that a span must hold. ``gap``: how far apart diagonals may lie to be
    merged. ``k``: words in a k-gram, at most those of the shortest template.
    """
    templates = template_grams(templates_of(spark, base, wordings), k)
    spans = merge_diagonals(hits(df, key, text, templates, k), gap)
    covered = F.col("_held") / F.col("grams")
    is_whole = F.col("is_base") & (F.col("_whole") > 0)
    verified = is_whole | (~F.col("is_base") & (covered >= share))
    names = lambda wanted: F.concat_ws(",", F.array_sort(F.collect_set(F.when(wanted, F.col("label")))))
    return (
        spans.groupBy("_row", F.col("_key").alias(key), F.col("_n").cast("long").alias("n_words"))
        .agg(
            F.coalesce(F.sum(F.when(is_whole, F.col("_whole"))), F.lit(0)).cast("long").alias("n_base"),
            F.min(F.when(is_whole, F.col("_start"))).cast("long").alias("first_word"),
            F.max(F.when(is_whole, F.col("_end"))).cast("long").alias("last_word"),
            names(is_whole).alias("base_labels"),
            names(verified).alias("labels"),
            F.coalesce(
                F.max(F.when(is_whole, F.lit(1.0)).when(~F.col("is_base"), covered)), F.lit(0.0)
            ).alias("score"),
            F.array_sort(
                F.collect_list(
                    F.when(
                        verified,
                        F.struct(
                            F.col("_first").alias("from_word"),
                            (F.col("_last") + k).cast("int").alias("to_word"),
                            "label",
                        ),
                    )
                )
            ).alias("spans"),
        )
        .drop("_row")
    )
