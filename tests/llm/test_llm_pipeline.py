"""The pipeline, stage by stage, against plain Python on the same input."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_llm_hashes import plain_components, plain_fingerprint
from test_llm_texts import check_packed, scores

import corpus_pipeline as pipeline
from lotlens.llm import decontamination, quality, toxicity
from lotlens.llm.samples import fold

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Documents before and after every stage."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        path = os.path.join(folder, name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return dict(zip([n for n, _ in pipeline.STAGES], out))


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stage_names_and_columns(spark, stages):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "toxicity", "near_dedup", "decontamination", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == spark.read.parquet(f"{SF}/documents.parquet").columns


def test_quality_stage(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(before, labels, "doc_id", "text", "quality", fold(F.col("doc_id"), 5) != 0)
    rows = before.collect()
    kept = model.probability(quality.describe_all(pd.Series([r["text"] for r in rows]))) >= 0.3
    assert ids(after) == sorted(r["doc_id"] for r, k in zip(rows, kept) if k)


def test_toxicity_stage(spark, stages):
    before, after = stages["toxicity"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(before, labels, "doc_id", "text", "toxic", fold(F.col("doc_id"), 4) != 2)
    rows = before.collect()
    kept = scores(model, [r["text"] for r in rows]) < 0.3
    assert ids(after) == sorted(r["doc_id"] for r, k in zip(rows, kept) if k)


def test_near_dedup_stage(stages):
    before, after = stages["near_dedup"]
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in before.collect()]
    assert ids(after) == sorted({c for _, _, c in plain_components(prints, 2)})


def test_decontamination_stage(spark, stages):
    before, after = stages["decontamination"]
    items = [decontamination.words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = []
    for r in before.collect():
        words = decontamination.words_of(r["text"])
        far = all(
            decontamination.least_distance(decontamination.pattern_bits(i), len(i), words)[0] > decontamination.budget(len(i))
            for i in items
        )
        clean += [r["doc_id"]] if far else []
    assert ids(after) == sorted(clean)


def test_packing_stage(stages):
    before, after = stages["packing"]
    check_packed([(r["doc_id"], r["text"]) for r in before.collect()], after.collect())


def test_run_equals_its_stages(spark, stages):
    got = pipeline.run(spark, SF)
    last = stages["packing"][1]
    key = ["doc_id", "start", "length", "ids_crc32"]
    # which documents share a sequence may differ, the tokens of each may not
    cut = lambda df: sorted(map(tuple, df.select(*key, "doc_tokens").collect()))
    assert cut(got) == cut(last)


def test_odd_documents(spark):
    """Nulls, empty and repeated rows, clashing names and empty tables pass every stage."""
    rows = [(1, None), (2, ""), (3, "plain words in a row. " * 9), (3, "plain words in a row. " * 9), (None, "no id"), (4, "x" * 90_000)]
    docs = spark.createDataFrame([(*r, 0.1, [1], 2) for r in rows], "doc_id long, text string, score double, found array<int>, _score int")
    for some in (docs, docs.limit(0)):
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, some, SF)
            assert out.columns == docs.columns
            assert out.count() <= some.count()
        assert pipeline.STAGES[-1][1](spark, some, SF).count() >= (some.count() > 0)
    assert pipeline.near_dedup_stage(spark, docs, SF).count() <= 4
