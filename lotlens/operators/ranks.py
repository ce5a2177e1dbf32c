"""Exact ranks and order statistics without a one-task sort.

``percentile``, ``median``, ``ntile`` and ``row_number`` put a whole group into
one task. Here the distinct values are range-partitioned over the cluster, each
range knows the total weight of the ranges before it, and only the ranges that
hold a wanted position are looked into. Equal values are collapsed to one
weighted row first, so a value held by a third of the rows costs one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

Position = Callable[[Column], Column]


def weigh(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per distinct value, with its number of occurrences in ``weight``."""
    return df.groupBy(*by, *order).agg(F.count(F.lit(1)).alias("weight"))


def _ranges(weighted: DataFrame, by: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Range-partitioned rows and, per group and range, the weight before it.

    The rows are written out, at once, because range borders are sampled: two reads
    of an unwritten plan could cut the ranges differently. All else is lazy.
    """
    placed = materialize(
        weighted.select(*by, *order, "weight")
        .repartitionByRange(*[F.col(c) for c in [*by, *order]])
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    # one row per range plus one per group border: bounded by the partition count
    totals = placed.groupBy(*by, "_range").agg(F.sum("weight").alias("_len"))
    group = Window.partitionBy(*by) if by else Window.partitionBy()
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *by,
        "_range",
        F.coalesce(F.sum("_len").over(earlier), F.lit(0)).alias("_before_range"),
        "_len",
        F.sum("_len").over(group).alias("group_rows"),
    )
    return placed, totals


def _inside(by: Sequence[str], order: Sequence[str]) -> Column:
    w = Window.partitionBy(*by, "_range").orderBy(*order)
    return F.coalesce(
        F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )


def cumulative(weighted: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each weighted row with ``below`` (weight strictly before it) and the group size ``group_rows``."""
    placed, totals = _ranges(weighted, by, order)
    keys = [*by, "_range"]
    joined = placed.withColumn("_inside", _inside(by, order)).join(
        totals.select(*keys, "_before_range", "group_rows"), keys
    )
    return joined.select(
        *by, *order, "weight", (F.col("_before_range") + F.col("_inside")).alias("below"), "group_rows"
    )


def pick(
    weighted: DataFrame, by: Sequence[str], order: Sequence[str], positions: dict[str, Position]
) -> DataFrame:
    """The values at 0-based positions of each group's sorted rows.

    ``positions`` maps an output name to a function of the group size. Returns
    one row per group: keys, ``group_rows`` and one struct of the order columns per name.
    """
    placed, totals = _ranges(weighted, by, order)
    wanted = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("_name"), at(F.col("group_rows")).cast("long").alias("_at")
                )
                for name, at in positions.items()
            ]
        )
    )
    targets = (
        totals.withColumn("_want", wanted)
        .filter(
            (F.col("_want._at") >= F.col("_before_range"))
            & (F.col("_want._at") < F.col("_before_range") + F.col("_len"))
        )
        .select(*by, "_range", "group_rows", "_before_range", "_want._name", "_want._at")
    )
    keys = [*by, "_range"]
    rows = placed.join(targets, keys, "left_semi").withColumn("_inside", _inside(by, order))
    start = F.col("_before_range") + F.col("_inside")
    hits = rows.join(targets, keys).filter(
        (F.col("_at") >= start) & (F.col("_at") < start + F.col("weight"))
    )
    values = [
        F.max(F.when(F.col("_name") == name, F.struct(*order))).alias(name) for name in positions
    ]
    return hits.groupBy(*by).agg(F.max("group_rows").alias("group_rows"), *values)


def order_statistics(
    df: DataFrame, by: Sequence[str], value: str, positions: dict[str, Position]
) -> DataFrame:
    """Values of one column at the given positions, as plain columns."""
    known = df.filter(F.col(value).isNotNull())
    picked = pick(weigh(known, by, [value]), by, [value], positions)
    return picked.select(
        *by, "group_rows", *[F.col(name).getField(value).alias(name) for name in positions]
    )


def nearest_rank(p: float) -> Position:
    """Position floor(p * (n - 1))."""
    return lambda n: F.floor(F.lit(p) * (n - 1))


def upper_median(n: Column) -> Column:
    return F.floor(n / 2)


def exact_median(weighted: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Interpolated median of a weighted column (mean of the two middle values), and ``group_rows``."""
    picked = pick(
        weighted,
        by,
        [value],
        {"_lo": lambda n: F.floor((n - 1) / 2), "_hi": lambda n: F.floor(n / 2)},
    )
    middle = (F.col("_lo").getField(value) + F.col("_hi").getField(value)) / 2
    return picked.select(*by, "group_rows", middle.alias(out))


def quantile_cuts(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles, one column ``q0..`` per probability."""
    spots: dict[str, Position] = {}
    for i, p in enumerate(probs):
        spots[f"_lo{i}"] = nearest_rank(p)
        spots[f"_hi{i}"] = lambda n, p=p: F.ceil(F.lit(p) * (n - 1))
    found = order_statistics(df, by, value, spots)
    cuts = []
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("group_rows") - 1)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        cuts.append((lo + (hi - lo) * (at - F.floor(at))).alias(f"q{i}"))
    return found.select(*by, "group_rows", *cuts)


def ntile_by(
    df: DataFrame, by: Sequence[str], order: str, tie: str, n: int = 4, out: str = "ntile"
) -> DataFrame:
    """``ntile(n)`` over ``by`` ordered by ``order`` and the unique ``tie``.

    Only the last row of each bucket is searched for; the rows themselves are
    compared with these borders and are not sorted or moved.
    """

    def last_of(i: int) -> Position:
        return lambda rows: F.floor(rows / n) * i + F.least(F.lit(i), rows % n) - 1

    names = [f"_b{i}" for i in range(1, n)]
    borders = pick(
        df.select(*by, order, tie).withColumn("weight", F.lit(1).cast("long")),
        by,
        [order, tie],
        {name: last_of(i) for i, name in enumerate(names, 1)},
    ).drop("group_rows")
    bucket = F.lit(1)
    for name in names:
        border = F.col(name)
        after = (F.col(order) > border.getField(order)) | (
            (F.col(order) == border.getField(order)) & (F.col(tie) > border.getField(tie))
        )
        bucket = bucket + F.when(after, 1).otherwise(0)
    joined = df.join(borders, list(by), "left")
    return joined.withColumn(out, bucket).drop(*names)


def cut_at(value: Column, cuts: Sequence[Column], labels: Sequence) -> Column:
    """Right-closed classes by ascending cut points; the last label takes the rest."""
    chain = F.when(value <= cuts[0], F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1], strict=True):
        chain = chain.when(value <= cut, F.lit(label))
    return chain.when(value.isNotNull(), F.lit(labels[-1]))


def qcut(
    df: DataFrame, by: Sequence[str], value: str, labels: Sequence[str], out: str
) -> DataFrame:
    """Equal-frequency bins by interpolated cut points; equal values share a bin."""
    k = len(labels)
    cuts = quantile_cuts(df, by, value, [i / k for i in range(1, k)])
    names = [f"q{i}" for i in range(k - 1)]
    joined = df.join(cuts.drop("group_rows"), list(by), "left")
    return joined.withColumn(
        out, cut_at(F.col(value), [F.col(c) for c in names], labels)
    ).drop(*names)
