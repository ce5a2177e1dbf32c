"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is cut into segments, and the numbers of set bits in them are a point
on a grid. One differing bit moves the point by one step, so the Manhattan distance
of two points never exceeds the Hamming distance of their fingerprints. Two points
at most two steps apart meet in a cell: each fingerprint enters its own cell and
those one step away, and only cells with company give candidates. No pairs are made.

Candidates are verified exactly: two fingerprints differ in at most two bits if and
only if some value lies at most one bit from either of them, and this value lies in
a cell that they share. Each candidate names the values one bit away that belong to
its candidate cells; those who name the same value (at most 65) are linked.
The operator takes 0, 1 or 2 bits; larger distances need more than one step a side.

Equal fingerprints are one node; components come from ``components``.

Defined cases: a null or wordless text has the fingerprint 0 and is linked like any
other; a row without an id is linked too, its component is the least id reachable,
null if there is none; repeated rows each get their row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import ascii_lower, free_name, partitions, split_words
from .components import components
from .simhash import BITS, digits, distance, shingles, vote

SPACE = r"\x20\x09-\x0D"
SHINGLE, RADIUS, SEGMENTS = 3, 2, 16


def _row_hash(key: Column, text: Column) -> Column:
    """A hash of id and text; rows that share it are alike to this operator."""
    body = F.concat(F.coalesce(key.cast("string"), F.lit("none")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.unhex(F.sha2(body, 256))


def fingerprints(df: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """Rows (key, _row_hash, fingerprint as long) from XXH64 (seed 42) of word shingles, repeats included."""
    worded = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).alias("_key"),
        _row_hash(F.col(key), F.col(text)).alias("_row_hash"),
        split_words(ascii_lower(F.col(text)), SPACE).alias("_words"),
    )
    about = ["_row", "_key", "_row_hash"]
    terms = shingles(worded, about, "_words", shingle)
    votes = vote(terms, about, [F.when(F.col("_term").isNotNull(), F.xxhash64("_term"))])
    return votes.select(F.col("_key").alias(key), "_row_hash", F.col("_f0").alias("fingerprint"))


def _counts(bits: Column, segments: int) -> list[Column]:
    width = BITS // segments
    mask = F.lit((1 << width) - 1)
    return [F.bit_count(F.shiftrightunsigned(bits, width * s).bitwiseAND(mask)) for s in range(segments)]


def _cell(counts: list[Column]) -> Column:
    """The grid point as text; widths of up to nine bits have one digit per segment."""
    return F.concat(*[c.cast("string") for c in counts])


def _cells(bits: Column, segments: int, radius: int) -> Column:
    """Cells that a fingerprint enters, each with the values in it that lie up to one bit away."""
    counts, width = _counts(bits, segments), BITS // segments
    entered = [F.struct(_cell(counts).alias("cell"), F.lit(-1).alias("segment"), F.lit(0).alias("step"))]
    if radius:
        for s in range(segments):
            for step in (1, -1):
                moved = [c + step if i == s else c for i, c in enumerate(counts)]
                room = counts[s] < width if step == 1 else counts[s] > 0
                entered.append(
                    F.when(room, F.struct(_cell(moved).alias("cell"), F.lit(s).alias("segment"), F.lit(step).alias("step")))
                )
    return F.filter(F.array(*entered), lambda c: c.isNotNull())


def _meeting_values(bits: Column, segment: Column, step: Column, segments: int) -> Column:
    """The fingerprint itself for its own cell, else its one-bit neighbours that step into the cell."""
    width = BITS // segments
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), segment * width + i),
    )
    is_set = lambda flip: bits.bitwiseAND(flip) != 0
    wanted = F.filter(flips, lambda flip: F.when(step == 1, ~is_set(flip)).otherwise(is_set(flip)))
    return F.when(segment < 0, F.array(bits)).otherwise(F.transform(wanted, lambda flip: bits.bitwiseXOR(flip)))


def links(distinct: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """Rows (a, b) of fingerprints at most ``radius`` bits apart.

    Not every pair is listed, but any two linked fingerprints are connected.
    ``distinct`` has one row per fingerprint in column ``fingerprint`` and is read twice.
    """
    if not 0 <= radius <= 2 or BITS % segments:
        raise ValueError("radius is 0 to 2, and segments divide 64")
    if radius == 0:
        return distinct.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    f = F.col("fingerprint")
    # a small table of fingerprints is many cells: it is spread before, not after them
    spread = distinct.select("fingerprint").repartition(partitions(distinct.sparkSession), "fingerprint")
    entered = spread.select("fingerprint", F.inline(_cells(f, segments, radius)))
    entered = entered.withColumn("cell", F.xxhash64("cell"))  # two cells under one hash only add candidates
    shared = entered.groupBy("cell").count().filter("count > 1").select("cell")
    # a fingerprint has up to 33 cells, which size estimates don't know: neither side may be broadcast
    candidates = entered.join(shared.hint("merge"), "cell")
    named = candidates.select(
        "fingerprint", F.explode(_meeting_values(f, F.col("segment"), F.col("step"), segments)).alias("value")
    )
    # at most 65 fingerprints lie within one bit of a value
    met = named.groupBy("value").agg(F.collect_set("fingerprint").alias("all")).filter(F.size("all") > 1)
    if radius == 1:
        # a value that is no fingerprint joins neighbours two bits apart, which are no links then
        met = met.filter(F.array_contains("all", F.col("value"))).withColumn("least", F.col("value"))
    else:
        met = met.withColumn("least", F.array_min("all"))
    pairs = met.select(F.col("least").alias("a"), F.explode("all").alias("b")).filter("a <> b")
    return pairs.filter(distance(F.col("a"), F.col("b")) <= radius)


def _named(
    df: DataFrame, key: str, text: str, shingle: int, radius: int, segments: int
) -> tuple[DataFrame, DataFrame]:
    """All rows with their fingerprints, and for each fingerprint its component (_root, component_id)."""
    marked = materialize(fingerprints(df, key, text, shingle), "fingerprints")
    distinct = materialize(
        marked.groupBy("fingerprint").agg(F.min(key).alias("least_id")), "distinct-fingerprints"
    )
    # any total order of the fingerprints gives the same components
    roots = components(links(distinct, radius, segments), "a", "b")
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("_root")
    )
    joint = rooted.groupBy("_root").agg(F.min("least_id").alias("component_id"))
    named = materialize(rooted.join(joint, "_root").select("fingerprint", "_root", "component_id"), "named-fingerprints")
    release(distinct)
    return marked, named


def keep_one(
    df: DataFrame, key: str, text: str, *, shingle: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS
) -> DataFrame:
    """Of each component one row: that of the least id, ties by a hash of the text; columns as in ``df``.

    A component whose rows all lack an id keeps one of them. Texts are shuffled once,
    since the semi join and the removal of repeated rows have the same key.
    """
    marked, named = _named(df, key, text, shingle, radius, segments)
    # a null id sorts last
    order = F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.col("_row_hash").alias("hash"))
    name = free_name(df, "_row_hash")
    kept = marked.join(named, "fingerprint").groupBy("_root").agg(F.min(order)["hash"].alias(name))
    hashed = df.withColumn(name, _row_hash(F.col(key), F.col(text)))
    return hashed.join(kept, name, "left_semi").dropDuplicates([name]).select(*df.columns)


def near_duplicates(
    df: DataFrame, key: str, text: str, *, shingle: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS
) -> DataFrame:
    """Rows (key, fingerprint as 16 hex digits, component_id), one per row of ``df``."""
    marked, named = _named(df, key, text, shingle, radius, segments)
    return marked.join(named, "fingerprint").select(
        key, digits(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )
