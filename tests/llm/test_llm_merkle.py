"""Merkle manifests against a tree built level by level."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from lotlens.llm import merkle
from lotlens.llm.queries import op13_merkle

SF = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DOC = "doc_id long, source string, lang string, n_chars long, text string"
OUT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_proof(levels, i):
    found = []
    for level in levels[:-1]:
        if i ^ 1 < len(level):
            found.append(level[i ^ 1])
        i >>= 1
    return found


def plain_fold(levels, i, node):
    for level in levels[:-1]:
        run = [node if j == i else level[j] for j in range(i & ~1, min((i | 1) + 1, len(level)))]
        node, i = digest(*run), i >> 1
    return node


def plain_leaf(row):
    text = ["-" if v is None else str(v) for v in row]
    return digest(*["-" if v is None else f"{len(t.encode())}:{t}" for v, t in zip(row, text)])


def plain_manifest(rows):
    """Rows as the query gives them; rows are (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[lang] = own, plain_levels([plain_leaf(r) for r in own])
    top = plain_levels([trees[lang][1][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, r in enumerate(own):
            changed = r
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                changed = (*r[:3], r[3] + 1, r[4])
            proof = plain_proof(levels, i) + plain_proof(top, place)
            folded = plain_fold(top, place, plain_fold(levels, i, plain_leaf(changed)))
            out.append((r[0], plain_leaf(r), levels[-1][0], top[-1][0], digest(*proof), folded, folded == top[-1][0]))
    return out


def ordered(rows):
    return sorted(rows, key=str)


def proved(df, height):
    leaf = merkle.leaf_digest([F.col(c) for c in FIELDS])
    more = [F.col("n_chars").cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(tampered, merkle.leaf_digest(more)).otherwise(leaf)
    return merkle.prove(df, "lang", "doc_id", leaf, changed, height)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 32, 33, 100])
def test_positions_in_the_log(n):
    leaves = [digest(str(i)) for i in range(n)]
    levels = plain_levels(leaves)
    log = merkle.append_all(leaves, merkle.height_of(n))
    at = {merkle.position(h, i, n): node for h, level in enumerate(levels) for i, node in enumerate(level)}
    assert [at[p] for p in range(len(log))] == log and len(at) == len(log)
    for i in range(n):
        proof = merkle.siblings(log, i, n, merkle.height_of(n))
        assert proof == plain_proof(levels, i)
        assert merkle.fold(leaves[i], proof, i, n) == (levels[-1][0], len(proof))


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest_equals_plain_trees(spark, height):
    state = random.Random(height)
    langs = ["en"] * 6 + ["de", "é", "", None, "-", "=en", "zz\U0001f600", "￮"]
    rows = [
        (i if state.random() < 0.95 else None, state.choice(["a", None]), state.choice(langs), state.choice([3, 0, None, 2**63 - 1]), "t" * (i % 4) or None)
        for i in range(140)
    ]
    rows += rows[:9] + [(500, "x", "lone", 5, "é" * 70_000), (rows[3][0], "other", "en", 1, "same id")]
    df = spark.createDataFrame(rows, DOC).withColumns({"_index": F.lit(0), "_tree": F.lit("x"), "root": F.lit(1)})
    got = proved(df, height)
    assert got.columns == OUT
    assert ordered(tuple(r) for r in got.collect()) == ordered(plain_manifest(rows))


def test_small_tables(spark):
    for rows in ([], [(1, "s", "en", 4, "text")], [(None, None, None, None, None)], [(7, "", None, 1, ""), (7, "", None, 1, "")]):
        got = proved(spark.createDataFrame(rows, DOC), 2)
        assert ordered(tuple(r) for r in got.collect()) == ordered(plain_manifest(rows))


def test_query_equals_plain_trees(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*FIELDS).collect()]
    got = op13_merkle(spark, SF)
    assert ordered(tuple(r) for r in got.collect()) == ordered(plain_manifest(rows))
    assert {False, True} == {r["verified"] for r in got.select("verified").distinct().collect()}
