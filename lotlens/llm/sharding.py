"""Shards of indivisible groups by best-fit-decreasing bin packing.

Groups are sorted by size, the largest first, and each enters the shard with the
least remaining room that still holds it. The shards' rooms are kept in a balanced
tree. Groups of one size class are interchangeable, so the packing reads only a
histogram of the classes: about a thousand classes for each doubling of the size,
however many groups there are. Spark numbers the groups of a class and looks up in
which shard a number falls.

A fixed number of shards is served by searching the least capacity for which the
packing needs no more shards. A group above the mean size of the shards still to
be filled gets one to itself, and the search goes on with the others.

Defined cases: a null size counts as 0; rows of a null group key form one group;
repeated rows all keep a place; an empty table gives no rows; a column ``shard`` is
replaced, any other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name, numbered, small_table

CLASS_BITS = 10  # a class's size exceeds its groups' sizes by less than one part in 2**10


class Rooms:
    """Remaining rooms of shards in a treap: least room of at least x, insert and remove in log time."""

    def __init__(self):
        self.root = None  # [room, shard, priority, left, right]

    @staticmethod
    def _priority(shard: int) -> int:
        return (shard * 2654435761 + 12345) % 4294967291

    def _split(self, node, key):
        """Nodes below ``key``, nodes from it on."""
        if node is None:
            return None, None
        if (node[0], node[1]) < key:
            node[4], right = self._split(node[4], key)
            return node, right
        left, node[3] = self._split(node[3], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[2] > b[2]:
            a[4] = self._merge(a[4], b)
            return a
        b[3] = self._merge(a, b[3])
        return b

    def add(self, room: int, shard: int) -> None:
        left, right = self._split(self.root, (room, shard))
        node = [room, shard, self._priority(shard), None, None]
        self.root = self._merge(self._merge(left, node), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the shard with the least room that holds ``size``."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        node = right
        while node[3] is not None:
            node = node[3]
        _, rest = self._split(right, (node[0], node[1] + 1))
        self.root = self._merge(left, rest)
        return node[0], node[1]


def best_fit_decreasing(
    histogram: Iterable[tuple[int, int]], capacity: int, most: int | None = None
) -> list[tuple[int, int, int, int]] | None:
    """Pack ``(size, count)`` classes; rows ``(size, from number, to number, shard)``.

    None if more than ``most`` shards are needed. A class larger than the
    capacity cannot be packed at all and raises ValueError.
    """
    rooms, used, plan = Rooms(), 0, []
    for size, count in sorted(histogram, reverse=True):
        if size > capacity:
            raise ValueError(f"a group of {size} exceeds the capacity {capacity}")
        done = 0
        while done < count:
            found = rooms.take_tightest(size)
            if found is None:
                if most is not None and used >= most:
                    return None
                found, used = (capacity, used), used + 1
            room, shard = found
            fits = min(count - done, room // size)
            plan.append((size, done, done + fits, shard))
            done += fits
            rooms.add(room - fits * size, shard)
    return plan


def fixed_number(histogram: Iterable[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """The packing of least capacity into ``shards`` shards, groups above the mean set apart."""
    left = {size: count for size, count in histogram if count}
    plan, first = [], 0
    while left and first < shards - 1:
        size = max(left)
        if size * (shards - first) <= sum(s * c for s, c in left.items()):
            break
        left[size] -= 1
        plan.append((size, left[size], left[size] + 1, first))
        first += 1
        left = {s: c for s, c in left.items() if c}
    if not left:
        return plan
    n, total = shards - first, sum(s * c for s, c in left.items())
    low, high = max(max(left), -(-total // n)), 2 * max(max(left), -(-total // n)) + max(left)
    if n == 1:
        low = high = total
    while low < high:
        middle = (low + high) // 2
        if best_fit_decreasing(left.items(), middle, n) is None:
            low = middle + 1
        else:
            high = middle
    packed = best_fit_decreasing(left.items(), high, n)
    return plan + [(s, a, b, first + shard) for s, a, b, shard in packed]


def size_class(size: Column) -> Column:
    """``size`` rounded up to its leading CLASS_BITS + 1 binary digits; 0 counts as 1."""
    size = F.greatest(size, F.lit(1))
    digits = F.length(F.bin(size))
    step = F.pow(F.lit(2.0), F.greatest(digits - (CLASS_BITS + 1), F.lit(0))).cast("long")
    return (F.ceil(size / step) * step).cast("long")


def shard_groups(
    df: DataFrame, group: str, size: str, *, shards: int | None = None, capacity: int | None = None
) -> DataFrame:
    """The rows of ``df`` with a column ``shard``; rows of a group share their shard.

    Give either ``shards``, a number of shards to fill evenly, or ``capacity``, the
    most a shard may hold, of which as few as possible are opened. ``df`` is read
    twice. The histogram that reaches the driver has at most 2**10 rows for each
    doubling of the group size. With ``capacity`` the driver's plan grows with the
    shards opened, so it is not broadcast unasked.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    groups = materialize(
        df.groupBy(F.col(group).alias("_group"))
        .agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("_size"))
        .select("_group", size_class(F.col("_size")).alias("_class")),
        "shard-groups",
    )
    histogram = [tuple(r) for r in groups.groupBy("_class").count().collect()]
    plan = (
        fixed_number(histogram, shards) if capacity is None else best_fit_decreasing(histogram, capacity)
    )
    spans = small_table(df.sparkSession, plan, "_class long, _from long, _to long, shard int")
    if capacity is None:  # classes plus places where one of the shards filled up: bounded as the histogram
        spans = F.broadcast(spans)
    number = F.col("_number")
    placed = numbered(groups, ["_class"], ["_group"], "_number").join(
        spans,
        (groups["_class"] == spans["_class"]) & (number >= F.col("_from")) & (number < F.col("_to")),
    )
    kept = [c for c in df.columns if c != "shard"]
    own, name = free_name(df, "_group"), free_name(df, "_shard")
    placed = placed.select(F.col("_group").alias(own), F.col("shard").alias(name))
    met = df.join(placed, df[group].eqNullSafe(placed[own]))
    return met.select(*kept, F.col(name).alias("shard"))
