"""A training corpus from raw documents: four filters, then packing.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes it as
Parquet and reads it again as the next stage's documents. All but the last stage
return the columns of the documents. Rows without an id stay until near-duplicates
or packing decide about them; a null text counts as empty everywhere; an empty table
passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotlens.llm import decontamination, near_dedup, packing, quality, toxicity
from lotlens.llm.common import free_name, table
from lotlens.llm.queries import KEPT_FROM, QUALITY_FOLDS, QUALITY_HELD_OUT, TOXIC_FOLDS, TOXIC_HELD_OUT
from lotlens.llm.samples import fold
from lotlens.session import materialize, release

ORACLE_SQL = None  # trained models, XXH64 and byte-pair ids have no DuckDB counterpart


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    learn = fold(F.col("doc_id"), QUALITY_FOLDS) != QUALITY_HELD_OUT
    model = quality.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality", learn)
    name = free_name(docs, "_score")
    return quality.score(docs, "text", model, name).filter(F.col(name) >= KEPT_FROM).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not mark."""
    learn = fold(F.col("doc_id"), TOXIC_FOLDS) != TOXIC_HELD_OUT
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", learn)
    name = free_name(docs, "_score")
    return toxicity.score(docs, "text", model, name).filter(F.col(name) < KEPT_FROM).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the least id."""
    return near_dedup.keep_one(docs, "doc_id", "text")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    name = free_name(docs, "_found")
    items = table(spark, sf_dir, "benchmark")
    found = decontamination.with_matches(docs, "text", items, "item_id", "text", name)
    return found.filter(F.size(name) == 0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack(docs, "doc_id", "text")


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        after = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if number:
            release(docs)
        docs = after
    return docs
