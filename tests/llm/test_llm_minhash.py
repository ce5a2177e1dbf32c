"""MinHash near-duplicates against brute force."""

import random
import re
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotlens.llm import minhash
from lotlens.llm.queries import op11_minhash_dedup
from tests.conftest import values

DOC = "doc_id long, text string"
SF = "/root/testdata/sf0.001"


def plain_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def plain_components(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                inside = len(sets[i] & sets[j])
                if inside * 100 >= (len(sets[i]) + len(sets[j]) - inside) * percent:
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(rows):
        known = [k for k in (least.get(find(i)), key) if k is not None]
        least[find(i)] = min(known, default=None)
    return [(key, len(sets[i]), least[find(i)], key == least[find(i)]) for i, (key, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=str)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, groups=6, copies=25):
    """Groups of copies with 0 to 6 edits, cut ones, and texts that share only a passage."""
    rng = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 90, 200, 700]))]
        for _ in range(copies):
            kind = rng.random()
            if kind < 0.75:
                texts.append(edited(rng, base, rng.randrange(7)))
            elif kind < 0.9:
                texts.append(" ".join(base[: int(len(base) * rng.uniform(0.7, 1))]))
            else:
                own = [f"own{rng.randrange(10**6)}" for _ in range(60)]
                texts.append(" ".join(own + base[:40]))
    texts += texts[:5] + [t.upper() for t in texts[5:8]]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [1, 16])
def test_components_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 8)
    monkeypatch.setattr(minhash, "BLOCK_HASHES", 2000)
    rows = corpus(5)
    got = minhash.near_duplicates(spark.createDataFrame(rows, DOC), "doc_id", "text")
    assert ordered(tuple(r) for r in got.collect()) == ordered(plain_components(rows))


def test_defined_cases(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [
        (7, "one two"), (3, "One  TWO\n"), (None, "one two"), (9, "two one"), (4, ""), (5, None), (6, " \t\x0b"),
        (None, ""), (None, "alone without any number"), (12, long), (11, long + " end"), (13, "é É a b c d"),
        (14, "é É A B C D"), (15, "é é a b c d"), (3, "One  TWO\n"),
    ]
    df = spark.createDataFrame(rows, DOC).withColumns({"_set": F.lit(1), "_key": F.lit("x"), "n_shingles": F.lit(0)})
    got = minhash.near_duplicates(df, "doc_id", "text")
    wanted = plain_components(rows)
    assert ordered(tuple(r) for r in got.collect()) == ordered(wanted)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    empty = minhash.near_duplicates(spark.createDataFrame([], DOC), "doc_id", "text")
    assert empty.collect() == []


def test_sets_at_the_threshold_are_linked(spark):
    # 85 shingles of 100, and 84 of 99
    base = [f"a{i}" for i in range(104)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:89]))]
    assert [len(plain_set(t)) for _, t in rows] == [100, 85]
    linked = minhash.near_duplicates(spark.createDataFrame(rows, DOC), "doc_id", "text", bands=112, rows=2)
    assert {r["component_id"] for r in linked.collect()} == {1}
    apart = [(1, " ".join(base[:103])), (2, " ".join(base[:88]))]
    apart = minhash.near_duplicates(spark.createDataFrame(apart, DOC), "doc_id", "text", bands=112, rows=2)
    assert {r["component_id"] for r in apart.collect()} == {1, 2}


def test_posterior_bounds():
    least = minhash.least_matches(85, 32, 224, 1e-9)
    below = lambda n, m: sum(comb(n + 1, k) * 0.85**k * 0.15 ** (n + 1 - k) for k in range(m + 1))
    for n, m in zip(range(32, 225, 32), least):
        assert below(n, m) >= 1e-9 > (below(n, m - 1) if m else 0)
    # the same by integrating the posterior density of a uniform prior
    s = np.linspace(0, 1, 200_001)
    for n, m in ((32, 15), (64, 40)):
        density = s**m * (1 - s) ** (n - m)
        assert density[s >= 0.85].sum() / density.sum() == pytest.approx(below(n, m), rel=1e-2)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    for shared in (0, 1000, 1800, 2000):
        b = np.concatenate([a[:shared], rng.integers(0, 1 << 63, 2000 - shared).astype(np.uint64)])
        one, two = minhash.signature(a, 2048), minhash.signature(b, 2048)
        assert (one == two).mean() == pytest.approx(shared / (4000 - shared), abs=0.04)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert values(op11_minhash_dedup(spark, SF)) == values(spark.createDataFrame(plain_components(rows), "doc_id long, n long, c long, kept boolean"))
