"""SimHash votes as plain aggregates.

Every term hash votes on each bit of a fingerprint. Four votes of 16 bits share one
long, so that 64 counters cost 16 sums. A lane must not overflow: words are dealt
into blocks of ``BLOCK`` and a term weighs at most ``MOST_WEIGHT``; the blocks of a
text are added up afterwards in counters of full width.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANE_ONES = 0x0001000100010001
BLOCK, MOST_WEIGHT = 2048, 15  # 2048 * 15 < 2**15: the top lane stays positive
BITS = 64


def shingles(df: DataFrame, keys: list[str], words: str, size: int) -> DataFrame:
    """Rows (keys, _at, _term): all runs of ``size`` words, the whole sequence if there are fewer.

    A text without words keeps one row with a null term.
    """
    spread = df.select(*keys, words, F.size(words).alias("_n"), F.posexplode_outer(words).alias("_at", "_word"))
    following = [F.get(words, F.col("_at") + i) for i in range(1, size)]
    full = F.col("_at") + size <= F.col("_n")
    return (
        spread.filter(full | F.coalesce(F.col("_at"), F.lit(0)).eqNullSafe(F.lit(0)))
        # concat_ws skips the words that a short sequence lacks
        .select(
            *keys,
            F.coalesce("_at", F.lit(0)).alias("_at"),
            F.when(F.col("_at").isNotNull(), F.concat_ws(" ", "_word", *following)).alias("_term"),
        )
    )


def vote(terms: DataFrame, keys: list[str], hashes: list[Column], weight: Column | None = None) -> DataFrame:
    """Columns ``_f0``, ``_f1``, ... with the 64 majority bits of each hash; no terms: all bits 0.

    A bit is 1 if the weight of the terms whose hash has it is over half of the text's.
    """
    names = [f"_h{i}" for i in range(len(hashes))]
    weighed = terms.select(
        *keys,
        F.shiftright("_at", BLOCK.bit_length() - 1).alias("_block"),
        *[h.alias(n) for h, n in zip(hashes, names)],
        (F.lit(1) if weight is None else weight).cast("long").alias("_weight"),
    )
    lane = lambda h, i: F.shiftrightunsigned(h, i).bitwiseAND(F.lit(LANE_ONES))
    once = weight is None
    sums = [
        F.sum(lane(n, i) if once else lane(n, i) * F.col("_weight")).alias(f"{n}_{i}") for n in names for i in range(16)
    ]
    total = F.sum(F.when(F.col(names[0]).isNotNull(), F.col("_weight"))).alias("_total")
    blocks = weighed.groupBy(*keys, "_block").agg(total, *sums)
    counted = blocks.groupBy(*keys).agg(
        F.sum("_total").alias("_total"),
        *[
            F.sum(F.shiftrightunsigned(f"{n}_{bit % 16}", 16 * (bit // 16)).bitwiseAND(F.lit(0xFFFF))).alias(
                f"{n}_bit{bit}"
            )
            for n in names
            for bit in range(BITS)
        ],
    )

    def majority(n: str) -> Column:
        ones = [
            F.when(F.col(f"{n}_bit{bit}") * 2 > F.col("_total"), F.lit(_signed(1 << bit))).otherwise(F.lit(0))
            for bit in range(BITS)
        ]
        return _tree(ones)

    return counted.select(*keys, *[majority(n).cast("long").alias(f"_f{i}") for i, n in enumerate(names)])


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _tree(parts: list[Column]) -> Column:
    """Bitwise OR of all, as a shallow tree."""
    while len(parts) > 1:
        parts = [reduce(lambda a, b: a.bitwiseOR(b), parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def digits(bits: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
