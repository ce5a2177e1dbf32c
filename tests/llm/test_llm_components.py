import random

import pytest
from pyspark.sql import functions as F

from lotlens.llm import components as c
from tests.conftest import values

SCHEMA = "a long, b long"


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return sorted((x, find(x)) for x in root if find(x) != x)


def shapes():
    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(40)]
    star = [(500, i) for i in range(501, 900)]  # its centre is the least node
    late = [(2000, i) for i in range(1000, 1400)]  # its centre is the greatest
    two = [(3000, i) for i in range(3010, 3200)] + [(3001, i) for i in range(3150, 3400)]
    loose = [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(300)]
    return chain + star + late + two + loose


@pytest.mark.parametrize("heavy", [1, 20, 1000])
def test_components_equal_union_find(spark, monkeypatch, heavy):
    monkeypatch.setattr(c, "HEAVY", heavy)  # 1: no node is heavy; 1000: nearly all are
    links = shapes()
    found = c.components(spark.createDataFrame(links, SCHEMA), "a", "b")
    assert values(found) == sorted(plain(links), key=lambda r: (str(r[0]), str(r[1])))


def test_loops_and_repeated_links_and_empty_graphs(spark):
    found = c.components(spark.createDataFrame([(1, 1), (3, 2), (2, 3), (3, 2), (5, 5)], SCHEMA), "a", "b")
    assert values(found) == [(3, 2)]
    assert c.components(spark.createDataFrame([], SCHEMA), "a", "b").count() == 0


def test_a_centre_is_spread_and_the_broadcast_bounded(spark):
    edges = spark.createDataFrame([(1, i) for i in range(2, 3002)] + [(i, i + 1) for i in range(9000, 9500)], "lo long, hi long")
    both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
    rows = both.count()
    met, _ = c._with_least(both.repartition(8), "hi", "lo", rows)
    assert met.count() == rows
    centre = met.filter("hi = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(centre) >= 4 and max(r["count"] for r in centre) < 1500
    heavy = both.groupBy("hi").count().filter(F.col("count") * c.HEAVY > rows).count()
    assert heavy < c.HEAVY
