"""Document fingerprints: 128-bit SimHash and a search within a Hamming radius.

The terms are word pairs of the lower-cased text. A term weighs its number of
characters, up to 15, so that pairs of short function words say little; each
occurrence votes again. Two 64-bit hashes give 128 bits.

The search cuts fingerprints into blocks and shares ``radius`` out over them: two that
differ in at most ``radius`` bits are within its share in some block. There is one table
for each block, keyed by its bits; a query looks up every key within the block's share.
Few wide blocks cost more keys and many narrow ones more candidates, so the number of blocks
follows from the numbers of queries and fingerprints; any number finds the same.

Defined cases: a null text counts as empty; a text without words has all bits 0;
repeated rows each keep their row, ordered by id and then text; a null id comes last;
a table of one row is its own next row; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import ceil, comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import partitions, small_table, split_words
from .simhash import BITS, MOST_WEIGHT, _signed, digits, distance, shingles, vote

PAIR = 2
RANGES = 8  # several small ones a partition, so that hashing deals them out evenly
RADIUS = 17  # texts that share 0.8 of their five-word runs differ by up to 19 bits (README)
MOST_KEYS = 1 << 17  # keys of a query, which are one array at a time
TASK_KEYS = 1 << 22  # keys that one task makes
SPACE = r"\s"


def fingerprints(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` with the fingerprint in ``_f0`` and ``_f1``; ``keys`` must be unique."""
    worded = texts.select(*keys, split_words(F.lower(F.col(text)), SPACE).alias("_words"))
    terms = shingles(worded, keys, "_words", PAIR)
    term = F.col("_term")
    hashes = [F.xxhash64(term), F.xxhash64(F.lit(1), term)]
    hashes = [F.when(term.isNotNull(), h) for h in hashes]
    return vote(terms, keys, hashes, F.least(F.char_length(term), F.lit(MOST_WEIGHT)))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    return 1 - (distance(a[0], b[0]) + distance(a[1], b[1])) / (2.0 * BITS)


def _cuts(blocks: int) -> list[tuple[int, int]]:
    """First bit and end of ``blocks`` nearly equal blocks."""
    if blocks < 2:
        raise ValueError("a block has one long's bits at most")
    cuts = [round(i * 2 * BITS / blocks) for i in range(blocks + 1)]
    return list(zip(cuts, cuts[1:]))


def _bits(f0: Column, f1: Column, low: int, high: int) -> Column:
    """Bits ``low`` to ``high`` of the two longs, those of ``f1`` after those of ``f0``."""
    parts = []
    for f, start in ((f0, 0), (f1, BITS)):
        at, end = max(low - start, 0), min(high - start, BITS)
        if at < end:
            mask = F.lit((1 << (end - at)) - 1 if end - at < BITS else -1)
            parts.append(F.shiftleft(F.shiftrightunsigned(f, at).bitwiseAND(mask), max(start - low, 0)))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _shares(radius: int, blocks: int) -> list[int]:
    """Bits by which each block may differ; -1: the block is not needed.

    Were all blocks beyond their shares, they would differ by ``radius + 1`` bits in all.
    """
    each, more = divmod(radius + 1, blocks)
    return [each - 1 + (i < more) for i in range(blocks)]


def _needed(radius: int, blocks: int) -> list[tuple[int, int, int]]:
    """First bit, end and share of each block that has a table."""
    return [(*cut, share) for cut, share in zip(_cuts(blocks), _shares(radius, blocks)) if share >= 0]


def _keys(radius: int, blocks: int) -> list[tuple[int, int]]:
    """Per table, the keys that a query looks up and the bits of a key."""
    return [
        (sum(comb(high - low, n) for n in range(share + 1)), high - low) for low, high, share in _needed(radius, blocks)
    ]


def search_rows(queries: int, prints: int, radius: int, blocks: int) -> float:
    """Keys, candidates and filed fingerprints of a search, were all bits fair coins."""
    tables = _keys(radius, blocks)
    return queries * sum(keys * (1 + prints / 2**width) for keys, width in tables) + prints * len(tables)


def choose_blocks(queries: int, prints: int, radius: int = RADIUS) -> int:
    """The number of blocks with the fewest rows, among those with at most MOST_KEYS keys a query."""
    able = [b for b in range(2, max(radius + 1, 2) + 1) if sum(k for k, _ in _keys(radius, b)) <= MOST_KEYS]
    return min(able, key=lambda b: search_rows(queries, prints, radius, b))


def _masks(width: int, most: int) -> Column:
    """An array of all numbers of ``width`` bits with at most ``most`` ones."""
    masks = [_signed(sum(1 << b for b in ones)) for n in range(most + 1) for ones in combinations(range(width), n)]
    # one string becomes one literal, where an expression for each of 40,000 numbers would burden the plan
    return F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")


def block_tables(prints: DataFrame, radius: int, blocks: int, asked: bool = False) -> DataFrame:
    """``prints`` once per table, with the table's number and the block that is its key.

    With ``asked`` there is a row for every key within the block's share of ``radius``.
    """

    def keys(i: int, part: Column, masks: Column) -> Column:
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("_table"), part.bitwiseXOR(m).alias("_block")))

    tables = [
        keys(i, _bits(F.col("_f0"), F.col("_f1"), low, high), _masks(high - low, share if asked else 0))
        for i, (low, high, share) in enumerate(_needed(radius, blocks))
    ]
    return prints.select("*", F.inline(F.concat(*tables)))


def within_radius(
    queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int | None = None
) -> DataFrame:
    """``prints`` with (q0, q1): every print at most ``radius`` bits from a query, each pair once.

    Both sides have distinct rows (_f0, _f1), are counted, and then read once.
    """
    number = queries.count()
    blocks = blocks or choose_blocks(number, prints.count(), radius)
    # keys are many times their query, and partitions are merged by what they hold before
    tasks = ceil(number * sum(k for k, _ in _keys(radius, blocks)) / TASK_KEYS)
    spread = queries.select("_f0", "_f1").repartition(max(tasks, partitions(queries.sparkSession)), "_f0", "_f1")
    asked = block_tables(spread, radius, blocks, asked=True).select(
        F.col("_f0").alias("q0"), F.col("_f1").alias("q1"), "_table", "_block"
    )
    # size estimates don't know the keys of a query either: neither side may be broadcast
    filed = block_tables(prints, radius, blocks).hint("merge")
    apart = [F.col(q).bitwiseXOR(F.col(f)) for q, f in (("q0", "_f0"), ("q1", "_f1"))]
    near = F.bit_count(apart[0]) + F.bit_count(apart[1]) <= radius
    # a pair that meets in several tables counts in the first of them
    first = F.coalesce(
        *[
            F.when(F.bit_count(_bits(*apart, low, high)) <= share, F.lit(i))
            for i, (low, high, share) in enumerate(_needed(radius, blocks))
        ]
    )
    met = (asked["_table"] == filed["_table"]) & (asked["_block"] == filed["_block"])
    return asked.join(filed, met & near & (filed["_table"] == first)).select("q0", "q1", *prints.columns)


def _range_number(key: Column, cuts: list) -> Column:
    """How many of the sorted ``cuts`` are not above ``key``, found in two short looks; null: -1."""
    if not cuts:
        return F.when(key.isNull(), F.lit(-1)).otherwise(F.lit(0))
    stride = max(1, int(len(cuts) ** 0.5))
    below = lambda values: F.size(F.filter(values, lambda x: x <= key))
    stretch = F.greatest(below(F.array(*map(F.lit, cuts[::stride]))) - 1, F.lit(0)) * stride
    inside = F.slice(F.array(*map(F.lit, cuts)), stretch + 1, F.lit(stride))
    return F.when(key.isNull(), F.lit(-1)).otherwise(stretch + below(inside))


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every row in descending order of the numeric key, with the next row's text; the first follows the last.

    Columns ``_range`` and ``_place`` number the rows, from high keys to low within a
    range. The ranges are cut at approximate quantiles of the key. The highest row of
    a range is copied to the end of the range above it (the topmost one's to the end of
    the lowest), so that each range is ordered for itself. The driver holds one key per
    range, of which there are RANGES for each shuffle partition.
    """
    rows = df.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    ranges = RANGES * partitions(df.sparkSession)
    at = [i / ranges for i in range(1, ranges)]
    cuts = sorted(set(rows.select(F.percentile_approx("_key", at, 10 * ranges)).first()[0] or []))
    dealt = rows.withColumn("_range", _range_number(F.col("_key"), cuts))
    heads = sorted(tuple(r) for r in dealt.groupBy("_range").agg(F.max("_key")).collect())[::-1]
    goes = [(head, above) for (_, head), (above, _) in zip(heads, heads[-1:] + heads[:-1])]
    copied_to = small_table(df.sparkSession, goes, f"_head {df.schema[key].dataType.simpleString()}, _above int")
    own = F.struct(F.col("_range").alias("r"), F.lit(False).alias("c"))
    copy = F.struct(F.col("_above").alias("r"), F.lit(True).alias("c"))
    copied = (
        dealt.join(F.broadcast(copied_to), F.col("_key").eqNullSafe(F.col("_head")), "left")  # a row per range
        .select("_key", "_text", F.explode(F.when(F.col("_above").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("_to"))
        .select("_key", "_text", F.col("_to.r").alias("_range"), F.col("_to.c").alias("_copy"))
    )
    order = Window.partitionBy("_range").orderBy("_copy", F.desc_nulls_last("_key"), F.asc("_text"))
    return (
        copied.withColumn("_next_text", F.lead("_text").over(order))
        .withColumn("_place", F.row_number().over(order))
        .filter("not _copy")
        .drop("_copy")
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half of the code points replaced by the first as many of ``following``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half)
    )


def compare_with_edits(df: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness to each other and to the next row's."""
    followed = with_next(df, key, text).withColumn("_edited", edited(F.col("_text"), F.col("_next_text")))
    about = ["_range", "_place", "_key", "n_chars", "edited_sha256"]
    forms = F.array(
        F.struct(F.lit(False).alias("_is_edit"), F.col("_text").alias("_t")),
        F.struct(F.lit(True).alias("_is_edit"), F.col("_edited").alias("_t")),
    )
    both = followed.select(
        "_range",
        "_place",
        "_key",
        F.char_length("_text").cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.inline(forms),
    )
    voted = fingerprints(both, [*about, "_is_edit"], "_t")
    pick = lambda edit, name: F.max(F.when(F.col("_is_edit") == edit, F.col(name)))
    paired = materialize(
        voted.groupBy(*about).agg(
            pick(False, "_f0").alias("_f0"),
            pick(False, "_f1").alias("_f1"),
            pick(True, "_f0").alias("_e0"),
            pick(True, "_f1").alias("_e1"),
        ),
        "fingerprints",
    )
    # after a range's last row comes the first of the range below: one row per range
    first = [tuple(r) for r in paired.filter("_place = 1").select("_range", "_f0", "_f1").collect()]
    first.sort(reverse=True)
    heads = [(r, *after[1:]) for (r, *_), after in zip(first, first[1:] + first[:1])]
    heads = small_table(df.sparkSession, heads, "_range int, _b0 long, _b1 long")
    order = Window.partitionBy("_range").orderBy("_place")
    last = F.lead("_f0").over(order).isNull()
    return (
        paired.withColumn("_last", last)
        .withColumn("_n0", F.lead("_f0").over(order))
        .withColumn("_n1", F.lead("_f1").over(order))
        .join(F.broadcast(heads), "_range")
        .select(
            F.col("_key").alias(key),
            "n_chars",
            "edited_sha256",
            F.concat(digits(F.col("_f0")), digits(F.col("_f1"))).alias("fingerprint"),
            F.concat(digits(F.col("_e0")), digits(F.col("_e1"))).alias("edited_fingerprint"),
            likeness((F.col("_f0"), F.col("_f1")), (F.col("_e0"), F.col("_e1"))).alias("near_edited"),
            likeness(
                (F.col("_f0"), F.col("_f1")),
                (F.when(F.col("_last"), F.col("_b0")).otherwise(F.col("_n0")), F.when(F.col("_last"), F.col("_b1")).otherwise(F.col("_n1"))),
            ).alias("near_next"),
            "_f0",
            "_f1",
        )
    )


def count_near(prints: DataFrame, asked: Column, radius: int = RADIUS, blocks: int | None = None) -> DataFrame:
    """``prints`` with ``n_near``: other rows within ``radius`` bits, for rows where ``asked`` holds; else null.

    ``prints`` is read twice.
    """
    kinds = prints.groupBy("_f0", "_f1").agg(F.count(F.lit(1)).alias("_rows"), F.max(asked).alias("_asked"))
    kinds = materialize(kinds, "prints")
    near = (
        within_radius(kinds.filter("_asked"), kinds.drop("_asked"), radius, blocks)
        .groupBy(F.col("q0").alias("_f0"), F.col("q1").alias("_f1"))
        .agg((F.sum("_rows") - 1).alias("_near"))
    )
    return prints.join(near, ["_f0", "_f1"], "left").withColumn("n_near", F.when(asked, F.col("_near"))).drop("_near")
