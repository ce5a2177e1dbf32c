"""Merkle manifest of a table: one tree for each group of rows, one tree over the groups.

A row's leaf is the hash of its columns. A tree pairs neighbours level by level; a last node
without a neighbour is hashed alone. Rows get their places by a range partitioning, so that
no group is ordered in one task.

A tree is built by tiers of aligned builders. A builder takes 2**HEIGHT neighbouring nodes,
appends them to its part of the log and after each one the inner nodes which it
completes, children before parents, and at its end the nodes without a full subtree, lowest first.
A level's nodes hence need no addresses of their own. After e leaves a log holds
2e - popcount(e) nodes, since a perfect subtree of height h has 2**(h+1) - 1; so the place of
the node (level, index) is known from its subtree alone (``position``), and with it the place
of its sibling. The top nodes of a tier's builders are the leaves of the next tier.

A proof is read from the log from the top tier down: a node's siblings within its builder, then those of the
builder's top node. It costs one shuffle of a tier's nodes, not one for each level.

Defined cases: a null value is ``-``; rows without an id come first in their group, rows with
equal ids go by their leaf, repeated rows are separate leaves; a group of one row has the
leaf as its root, a table of one group has the group's root; a row without siblings has the
hash of the empty text as its proof; an empty table gives no rows; columns other than
those asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import partitions

HEIGHT = 10
LOG = "_tree string, _tier int, _builder long, _nodes array<string>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex sha256 of all values as text, each with its length in bytes in front; null: a dash."""
    text = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in text]
    return F.sha2(F.concat(*parts), 256)


def height_of(leaves: int) -> int:
    return max(leaves - 1, 0).bit_length()


def parent(children: Sequence[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def position(level: int, index: int, leaves: int) -> int:
    """Place of a node in the log of a tree of ``leaves``."""
    end = (index + 1) << level
    if end <= leaves:  # completed by its last leaf, after all that ends before it
        return 2 * (end - 1) - (end - 1).bit_count() + level
    # the log of all perfect subtrees, then one node for each level above the least set bit
    least = (leaves & -leaves).bit_length() - 1
    return 2 * leaves - leaves.bit_count() + level - least - 1


def append_all(leaves: Sequence[str], height: int) -> list[str]:
    """The log of one builder: nodes in the order of their completion."""
    log: list[str] = []
    open_: list[tuple[int, str]] = []  # roots of perfect subtrees that wait for their sibling
    for leaf in leaves:
        level, node = 0, leaf
        log.append(node)
        while open_ and open_[-1][0] == level:
            node = parent((open_.pop()[1], node))
            level += 1
            log.append(node)
        open_.append((level, node))
    last: str | None = None  # the node of the level below that has no full subtree
    for level in range(height):
        run = [last] if last is not None else []
        if open_ and open_[-1][0] == level:
            run.insert(0, open_.pop()[1])
        if run:
            last = parent(run)
            log.append(last)
    return log


def siblings(log: Sequence[str], index: int, leaves: int, height: int) -> list[str]:
    """Of a leaf, level by level; a level without a sibling has none."""
    found, width = [], leaves
    for level in range(height):
        other = index ^ 1
        if other < width:
            found.append(log[position(level, other, leaves)])
        index, width = index >> 1, (width + 1) >> 1
    return found


def fold(node: str, proof: Sequence[str], index: int, leaves: int) -> tuple[str, int]:
    """The root that a leaf and its siblings give, and how many siblings were used."""
    used, width = 0, leaves
    while width > 1:
        if index & 1:
            node = parent((proof[used], node))
        elif index + 1 < width:
            node = parent((node, proof[used]))
        else:
            node = parent((node,))
        used += (index ^ 1) < width
        index, width = index >> 1, (width + 1) >> 1
    return node, used


def placed(df: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``df``, stored, with ``_index`` (from 0) and ``_n`` of its row in its tree, by ``order``, nulls first."""
    by = [F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_any")]
    spread = df.withColumn("_any", F.monotonically_increasing_id())  # equal rows needn't meet in one range
    ranged = spread.repartitionByRange(partitions(df.sparkSession), *by).sortWithinPartitions(*by)
    row = F.monotonically_increasing_id()
    ranged = ranged.select(*df.columns, row.alias("_row"), F.spark_partition_id().alias("_part"))
    ranged = materialize(ranged, "ranged")
    parts = ranged.groupBy(tree, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    parts = materialize(parts, "parts")  # a row for each tree and range
    earlier = parts.select(F.col(tree).alias("_t"), F.col("_part").alias("_p"), F.col("_count").alias("_c"))
    met = parts.join(earlier, parts[tree].eqNullSafe(earlier["_t"]))
    before = F.coalesce(F.sum(F.when(F.col("_p") < F.col("_part"), F.col("_c"))), F.lit(0))
    starts = met.groupBy(F.col(tree).alias("_t"), F.col("_part").alias("_p"), "_first").agg(
        before.alias("_before"), F.sum("_c").alias("_n")
    )
    starts = materialize(starts, "starts")
    joined = ranged.join(starts, ranged[tree].eqNullSafe(starts["_t"]) & (ranged["_part"] == starts["_p"]))
    index = (F.col("_before") + F.col("_row") - F.col("_first")).alias("_index")
    out = materialize(joined.select(*df.columns, index, "_n"), "placed")
    release(ranged, parts, starts)
    return out


class Manifest(NamedTuple):
    """``log`` has the builders' parts, ``roots`` (_tree, _root); ``nodes`` of each tier have (_tree, _index, _n, _node)."""

    nodes: list[DataFrame]
    log: DataFrame
    roots: DataFrame

    def release(self) -> None:
        release(*self.nodes[1:], self.log, self.roots)


def build(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """Of stored leaves (_tree, _index, _n, _node); trees have text names that are not null."""
    spark = leaves.sparkSession

    def builder(tier: int):
        def write(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("_index")
            own = min(height, height_of(int(part["_n"].iloc[0])))
            log = append_all(part["_node"].tolist(), own)
            first = part.iloc[0]
            row = (first["_tree"], tier, first["_index"] >> height, log)
            return pd.DataFrame([row], columns=["_tree", "_tier", "_builder", "_nodes"])

        return write

    nodes, logs = [leaves], []
    while True:
        here, tier = nodes[-1].select("_tree", "_index", "_n", "_node"), len(logs)
        grouped = here.groupBy("_tree", F.shiftright("_index", height).alias("_builder"))
        log = materialize(grouped.applyInPandas(builder(tier), LOG), "merkle-log")
        logs.append(log)
        widths = here.groupBy("_tree").agg(F.max("_n").alias("_n"))
        above = F.shiftright(F.col("_n") + ((1 << height) - 1), height)
        tops = log.join(widths, "_tree").select(
            "_tree", F.col("_builder").alias("_index"), above.alias("_n"), F.element_at("_nodes", -1).alias("_node")
        )
        tops = materialize(tops, "tops")
        if not tops.filter("_n > 1").limit(1).count():
            break
        nodes.append(tops)
    whole = logs[0]
    for log in logs[1:]:
        whole = whole.unionByName(log)
    stored = materialize(whole, "merkle-log")
    single = tops.filter("_n = 1").select("_tree", F.col("_node").alias("_root"))
    release(*logs)
    return Manifest(nodes, stored, materialize(single, "roots"))


def with_paths(manifest: Manifest, extra: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """The leaves (_tree, _index, _n, ``extra`` columns) with ``_path``, their siblings up to the tree's root."""
    above = None
    for tier in range(len(manifest.nodes) - 1, -1, -1):
        columns = ["_tree", "_index", "_n", *(extra if tier == 0 else ())]
        nodes = manifest.nodes[tier].select(*columns, F.shiftright("_index", height).alias("_builder"))
        log = manifest.log.filter(F.col("_tier") == tier).select("_tree", "_builder", "_nodes")
        if above is None:
            log = log.withColumn("_path", F.array().cast("array<string>"))
        else:
            upper = above.select("_tree", F.col("_index").alias("_builder"), "_path")
            log = log.join(upper, ["_tree", "_builder"], "left")  # a tree of one builder has nothing above
        kinds = {c: nodes.schema[c].dataType.simpleString() for c in columns}
        above = nodes.groupBy("_tree", "_builder").cogroup(log.groupBy("_tree", "_builder")).applyInPandas(
            _extract(height), ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", _path array<string>"
        )
        if tier:
            above = materialize(above, "paths")
    return above


def _extract(height: int):
    def extract(nodes: pd.DataFrame, log: pd.DataFrame) -> pd.DataFrame:
        entry = log.iloc[0]
        part, upper = entry["_nodes"], entry["_path"]
        upper = [] if upper is None else list(upper)
        n, mask = int(nodes["_n"].iloc[0]), (1 << height) - 1
        own, leaves = min(height, height_of(n)), len(nodes)
        paths = [siblings(part, int(i) & mask, leaves, own) + upper for i in nodes["_index"]]
        return nodes.drop(columns="_builder").assign(_path=paths)

    return extract


def prove(df: DataFrame, group: str, key: str, leaf: Column, changed: Column, height: int = HEIGHT) -> DataFrame:
    """Rows (key, leaf, subroot, root, proof_sha256, folded_root, verified), one per row of ``df``.

    Groups are the trees, in the order of ``group`` with null first. ``leaf`` is what the
    manifest holds, ``changed`` is what the row gives when it is checked.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    rows = df.select(
        tree.alias("_tree"), F.col(group).alias("_group"), F.col(key).alias("_key"), leaf.alias("_node"),
        changed.alias("_changed"),
    )
    leaves = placed(materialize(rows, "leaves"), "_tree", ["_key", "_node"])
    manifest = build(leaves, height)
    # a group's name is any of its rows' values: they are equal
    names = leaves.groupBy("_tree").agg(F.min("_group").alias("_group"))
    groups = manifest.roots.join(names, "_tree").select(
        F.lit("").alias("_tree"), F.col("_tree").alias("_of"), "_group", F.col("_root").alias("_node")
    )
    groups = placed(materialize(groups, "groups"), "_tree", ["_group"])
    top = build(groups, height)
    group_paths = materialize(
        with_paths(top, ["_of", "_node"], height)
        .join(top.roots, "_tree")
        .select(
            F.col("_of").alias("_tree"), F.col("_node").alias("subroot"), F.col("_root").alias("root"),
            F.col("_index").alias("_place"), F.col("_n").alias("_groups"), F.col("_path").alias("_top"),
        ),
        "group-paths",
    )
    paths = with_paths(manifest, ["_key", "_node", "_changed"], height).join(group_paths, "_tree")

    def check(parts):
        for part in parts:
            proofs, roots = [], []
            for one in part.itertuples(index=False):
                own, over = list(one.path), list(one.top)
                proofs.append(parent(own + over))
                node, _ = fold(one.changed, own, one.index, one.n)
                roots.append(fold(node, over, one.place, one.groups)[0])
            yield pd.DataFrame(
                {
                    "_key": part["key"], "leaf": part["node"], "subroot": part["subroot"], "root": part["root"],
                    "proof_sha256": proofs, "folded_root": roots,
                }
            )

    kind = leaves.schema["_key"].dataType.simpleString()
    named = paths.select(*[F.col(c).alias(c.removeprefix("_")) for c in paths.columns if c != "_tree"])
    checked = named.mapInPandas(
        check, f"_key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    return checked.select(
        F.col("_key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
