"""Connected components of a graph given as an edge table.

Alternating large-star and small-star rounds: in each round every node sends its
neighbours to the least node around. Neither step gathers a node's neighbours in
one task: the least neighbour is a partial aggregate, and edges meet it in a join. Edges
of a node that has more than a thousandth of them stay where they are, since there are
fewer than a thousand such nodes, which go to all tasks; the others are joined by node.
Both halves of a round are written tables in the shared folder; those before them are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release

HEAVY = 1000  # a node with more than one in so many rows is heavy; there are fewer heavy nodes than this


def _with_least(edges: DataFrame, node: str, other: str, rows: int) -> tuple[DataFrame, DataFrame]:
    """``edges`` (``rows`` of them) with ``m``, the least ``other`` of their ``node``; and that per node."""
    per = edges.groupBy(node).agg(F.min(other).alias("m"), F.count(F.lit(1)).alias("n"))
    is_heavy = F.col("n") * HEAVY > rows
    heavy = per.filter(is_heavy).select(node, "m")
    marked = edges.join(F.broadcast(heavy), node, "left")
    light = per.filter(~is_heavy).select(node, "m")
    rest = marked.filter("m is null").drop("m").join(light, node)
    return marked.filter("m is not null").unionByName(rest), per.select(node, "m")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    met, _ = _with_least(both.select(F.col("hi").alias("u"), F.col("lo").alias("v")), "u", "v", 2 * rows)
    least = F.least("m", "u")
    return met.filter((F.col("v") > F.col("u")) & (F.col("v") != least)).select(
        F.col("v").alias("hi"), least.alias("lo")
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    met, least = _with_least(edges, "hi", "lo", rows)
    return (
        met.filter("lo <> m")
        .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        .unionByName(least.select("hi", F.col("m").alias("lo")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of ``links`` but the roots; root is the least node reachable.

    Links from a node to itself and repeated links are ignored.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        large = materialize(_large_star(edges, state[0]), "links")
        after = materialize(_small_star(large, state[0]), "links")  # a large star never adds rows
        release(edges, large)
        edges, before, state = after, state, _state(after)
        if state == before:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
