"""MinHash near-duplicates with sequential Bayesian verification.

A text's set is its distinct word shingles, kept as 64-bit hashes. Equal sets are one
class, so that copies of a text are handled once. A class has a signature of minima under
BANDS * ROWS hash functions, and classes that agree on all ROWS minima of a band meet in
its bucket. Two sets with the similarity 0.85 meet in at least one of 32 bands of 7 but for
4 in a million such pairs, sets with 0.9 but for 2 in ten billion.

Pairs that met are compared batch by batch of their signatures. With a uniform prior, m
matches among n minima leave a similarity of at least t the probability
P(Binomial(n + 1, t) <= m); a pair is given up as soon as this is below MISS. Survivors
are confirmed on the full sets, and only confirmed pairs are links.

A bucket never gives all its pairs:

* A bucket of up to SMALL classes gives its pairs, each pair once for all bands.
* A larger one gives the pairs with its least class. Their links are joined to components,
  and a bucket whose classes all have the same component is done. Of the others, a
  class leaves that cannot link to any class left: a shingle that only one of them
  has is in no intersection. Those that stay are compared in blocks of bounded bytes,
  without a row per pair, and only across components and across sizes that can link. This
  is exact, so no bucket is capped.

Defined cases: fewer words than a shingle are one shingle; a null text or one without words
has the empty set, links with nothing and is its own component; a null id never is the
least of a component that has an id, and a row without an id is kept if its component has
none; repeated rows each get their row; an empty table gives no rows; other columns are
ignored; sets exactly at the threshold are linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import ascii_lower, numbered, split_words
from .components import components

SPACE = r"\x20\x09-\x0D"
SHINGLE, PERCENT = 5, 85
BANDS, ROWS = 32, 7
BATCH = 32  # minima compared before the posterior is looked at again
MISS = 1e-9  # probability that a pair given up is a link after all
SMALL = 16
BLOCK_HASHES = 1 << 18  # hashes of full sets in one block
BLOCK_ROWS = 256
GOLDEN = 0x9E3779B97F4A7C15


def least_matches(percent: int, batch: int, minima: int, miss: float) -> list[int]:
    """Per batch, the fewest matches so far with which a pair goes on."""
    t, least = percent / 100, []
    for n in range(batch, minima + 1, batch):
        left, m = 0.0, 0
        while True:
            left += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if left >= miss:
                break
            m += 1
        least.append(m)
    return least


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` word hashes, of the whole sequence if shorter."""
    words = words.astype(np.uint64)
    size = min(size, len(words))
    runs, factor = np.full(len(words) - size + 1, size, np.uint64), 1
    for i in range(size):
        factor = factor * GOLDEN % (1 << 64)
        runs += words[i : len(words) - size + 1 + i] * np.uint64(factor | 1)
    runs ^= runs >> np.uint64(32)
    runs *= np.uint64(GOLDEN)
    runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def signature(shingles: np.ndarray, minima: int) -> np.ndarray:
    """Upper 16 bits of the least value under each of ``minima`` multiply-shift functions."""
    state = np.random.default_rng(11)
    a = state.integers(0, 1 << 64, minima, np.uint64) | np.uint64(1)
    b = state.integers(0, 1 << 64, minima, np.uint64)
    least = np.full(minima, ~np.uint64(0), np.uint64)
    for at in range(0, len(shingles), 256):
        least = np.minimum(least, (shingles[at : at + 256, None] * a + b).min(axis=0))
    # the low bits of a product are poor, and equal values stay equal when mixed
    least = (least ^ (least >> np.uint64(31))) * np.uint64(GOLDEN)
    return (least >> np.uint64(48)).astype(np.uint16)


def sketches(df: DataFrame, key: str, text: str, shingle: int, bands: int, rows: int) -> DataFrame:
    """Rows (_key, _sha of the text, _n, _set digest, _signature); the last two null without words."""
    words = F.transform(split_words(ascii_lower(F.col(text)), SPACE), lambda w: F.xxhash64(w))
    hashed = df.select(F.col(key).alias("_key"), _sha(F.col(text)).alias("_sha"), words.alias("_words"))

    def sketch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for found in part.pop("_words"):
                if len(found):
                    s = shingle_set(np.asarray(found), shingle)
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    out.append((len(s), digest, signature(s, bands * rows).tobytes()))
                else:
                    out.append((0, None, None))
            part["_n"], part["_set"], part["_signature"] = zip(*out) if out else ([], [], [])
            yield part

    kind = df.schema[key].dataType.simpleString()
    return hashed.mapInPandas(sketch, f"_key {kind}, _sha binary, _n long, _set binary, _signature binary")


def _sha(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def full_sets(df: DataFrame, text: str, shingle: int) -> DataFrame:
    """The table with a column ``_hashes`` in place of the text."""
    words = F.transform(split_words(ascii_lower(F.col(text)), SPACE), lambda w: F.xxhash64(w))
    rest = [c for c in df.columns if c != text]

    def sets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            part["_hashes"] = [shingle_set(np.asarray(w), shingle).astype(np.int64) for w in part.pop("_words")]
            yield part

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in rest)
    return df.select(*rest, words.alias("_words")).mapInPandas(sets, f"{kinds}, _hashes array<long>")


def _pairs_left(a: np.ndarray, b: np.ndarray, batch: int, least: list[int]) -> np.ndarray:
    """Of aligned signature rows, the places that no batch gives up."""
    left, matches = np.arange(len(a)), np.zeros(len(a), np.int32)
    for step, enough in enumerate(least):
        part = slice(step * batch, (step + 1) * batch)
        matches = matches + (a[left, part] == b[left, part]).sum(axis=1)
        go_on = matches >= enough
        left, matches = left[go_on], matches[go_on]
    return left


def _matrix(signatures: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), -1)


def _confirmed(a: str, b: str, percent: int) -> Column:
    inside = F.size(F.array_intersect(a, b))
    return inside * 100 >= (F.size(a) + F.size(b) - inside) * percent


def verify(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, batch: int, miss: float) -> DataFrame:
    """Pairs (a, b) of classes that are links: sequential comparison, then the full sets."""
    side = lambda df, name, column: df.select(F.col("_class").alias(name), F.col(column).alias(f"_{name}"))
    signed = pairs.join(side(classes, "a", "_signature"), "a").join(side(classes, "b", "_signature"), "b")

    def prune(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                a, b = _matrix(part["_a"]), _matrix(part["_b"])
                left = _pairs_left(a, b, batch, least_matches(percent, batch, a.shape[1], miss))
                yield part.iloc[left][["a", "b"]]

    survivors = signed.mapInPandas(prune, "a long, b long")
    both = survivors.join(side(sets, "a", "_hashes"), "a").join(side(sets, "b", "_hashes"), "b")
    return both.filter(_confirmed("_a", "_b", percent)).select("a", "b")


def _compare_blocks(percent: int, batch: int, miss: float):
    """Links between two blocks of classes (sides 0 and 1; one block with itself has side 0 only)."""

    def links(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["side", "_class"])
        side, ids, n = (part[c].to_numpy() for c in ("side", "_class", "_n"))
        signs, hashes = _matrix(part["_signature"]), [np.asarray(h) for h in part["_hashes"]]
        shared, found = part["_shared"].to_numpy(), []
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        comp = part["_comp"].to_numpy()
        least = least_matches(percent, batch, signs.shape[1], miss)
        second = np.flatnonzero(side == 1) if side[-1] else np.arange(len(part))
        for i in np.flatnonzero(side == 0):
            others = second[second > i]
            # the intersection is at most what both share with any class
            most = np.minimum(shared[i], shared[others])
            others = others[(comp[others] != comp[i]) & (most * 100 >= (n[others] + n[i] - most) * percent)]
            if not len(others):
                continue
            left = _pairs_left(np.broadcast_to(signs[i], (len(others), signs.shape[1])), signs[others], batch, least)
            for j in others[left]:
                p, q = find(comp[i]), find(comp[j])
                if p == q:
                    continue
                inside = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
                if inside * 100 >= (n[i] + n[j] - inside) * percent:
                    root[max(p, q)] = min(p, q)
                    found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def _block_links(members: DataFrame, percent: int, batch: int, miss: float) -> DataFrame:
    """Links within buckets across components, block against block.

    ``members`` has (_meet, _class, _comp, _n, _shared, _signature, _hashes). Blocks hold
    classes of about one size, and a size meets itself and the next only: sets whose sizes
    differ twofold can't reach half the similarity.
    """
    if percent < 50:
        raise ValueError("percent is 50 at least")
    size = F.floor(F.log2(F.col("_n").cast("double"))).cast("int")
    room = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_HASHES) / F.pow(F.lit(2.0), F.col("_size") + 1))))
    sized = members.select("_meet", "_class", "_comp", size.alias("_size"))
    # a component that fills blocks of its own never meets itself
    large = sized.groupBy("_meet", "_size", "_comp").agg(F.count(F.lit(1)).alias("_count"))
    large = large.filter(F.col("_count") >= BLOCK_ROWS).withColumn("_own", F.col("_comp")).drop("_count")
    sized = sized.join(large, ["_meet", "_size", "_comp"], "left").fillna(-1, subset=["_own"])
    sized = materialize(sized, "sized")
    group = ["_meet", "_size", "_own"]
    placed = numbered(sized, group, ["_comp", "_class"], "_number")
    number = F.struct("_own", F.floor(F.col("_number") / room))
    placed = materialize(placed.withColumn("_block", F.xxhash64(number)).select(*sized.columns, "_block"), "placed")
    blocks = placed.groupBy("_meet", "_size", "_block").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"))
    other = blocks.select("_meet", *[F.col(c).alias(f"{c}2") for c in ("_size", "_block", "_lo", "_hi")])
    same = F.col("_size2") == F.col("_size")
    met = blocks.join(other, "_meet").filter(
        ((same & (F.col("_block2") >= F.col("_block"))) | (F.col("_size2") == F.col("_size") + 1))
        & ~((F.col("_lo") == F.col("_hi2")) & (F.col("_hi") == F.col("_lo2")))  # all of one component
    )
    met = met.withColumn("_task", F.xxhash64("_meet", "_size", "_block", "_size2", "_block2"))
    alone = same & (F.col("_block2") == F.col("_block"))
    first = met.select("_meet", "_size", "_block", "_task", F.lit(0).alias("side"))
    second = met.filter(~alone).select(
        "_meet", F.col("_size2").alias("_size"), F.col("_block2").alias("_block"), "_task", F.lit(1).alias("side")
    )
    dealt = placed.join(first.unionByName(second), ["_meet", "_size", "_block"])
    described = members.select("_class", "_n", "_shared", "_signature", "_hashes").dropDuplicates(["_class"])
    rows = dealt.select("_task", "side", "_class", "_comp").join(described, "_class")
    return rows.groupBy("_task").applyInPandas(_compare_blocks(percent, batch, miss), "a long, b long")


def _bucket_members(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    """Rows (_meet, _class) of the buckets that several classes share, with (_count, _least)."""
    parts = [
        F.xxhash64(F.lit(band), F.substring("_signature", band * rows * 2 + 1, rows * 2)) for band in range(bands)
    ]
    entered = classes.select("_class", F.explode(F.array(*parts)).alias("_meet"))
    shared = entered.groupBy("_meet").agg(F.count(F.lit(1)).alias("_count"), F.min("_class").alias("_least"))
    # a class has one row for each band, which size estimates don't know: neither side may be broadcast
    return entered.join(shared.filter("_count > 1").hint("merge"), "_meet")


def _still_open(
    members: DataFrame, roots: DataFrame, sets: DataFrame, classes: DataFrame, percent: int
) -> tuple[DataFrame, list[DataFrame]]:
    """Members of large buckets that hold several components, without classes that can't link there."""
    large = members.filter(F.col("_count") > SMALL).select("_meet", "_class")
    comp = F.coalesce("root", "_class").alias("_comp")
    rooted = materialize(
        large.join(roots, large["_class"] == roots["node"], "left").select("_meet", "_class", comp), "rooted"
    )
    mixed = rooted.groupBy("_meet").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi")).filter("_lo <> _hi")
    mixed = materialize(rooted.join(mixed.select("_meet"), "_meet", "left_semi"), "mixed")
    left = materialize(sets.join(mixed.select("_class").distinct(), "_class", "left_semi"), "open-sets")
    spread = left.select("_class", F.explode("_hashes").alias("_hash"))
    twice = spread.groupBy("_hash").agg(F.count(F.lit(1)).alias("_classes")).filter("_classes > 1").select("_hash")
    shared = spread.join(twice, "_hash", "left_semi").groupBy("_class").agg(F.count(F.lit(1)).alias("_shared"))
    able = left.join(shared, "_class").withColumn("_n", F.size("_hashes").cast("long"))
    able = able.filter(F.col("_shared") * 100 >= F.col("_n") * percent)
    open_ = mixed.join(able, "_class").join(classes.select("_class", "_signature"), "_class")
    return open_, [rooted, mixed, left]


def near_duplicates(
    df: DataFrame,
    key: str,
    text: str,
    *,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    batch: int = BATCH,
    miss: float = MISS,
) -> DataFrame:
    """Rows (key, n_shingles, component_id, kept), one per row of ``df``."""
    if bands * rows % batch:
        raise ValueError("batch divides bands * rows")
    sketched = sketches(df, key, text, shingle, bands, rows)
    sketched = materialize(sketched.withColumn("_row", F.monotonically_increasing_id()), "sketches")
    worded = sketched.filter("_n > 0")
    named = worded.groupBy("_set").agg(F.min("_row").alias("_class"), F.min("_key").alias("_least"))
    named = materialize(named, "named-sets")
    first = worded.select(F.col("_row").alias("_class"), "_key", "_sha", "_signature")
    classes = materialize(first.join(named.select("_class"), "_class", "left_semi"), "classes")
    members = materialize(_bucket_members(classes, bands, rows), "bucket-members")

    # full sets of the classes that met another one, from their texts
    asked = classes.join(members.select("_class").distinct(), "_class", "left_semi").select("_class", "_key", "_sha")
    texts = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).withColumn("_sha", _sha(F.col("_text")))
    texts = texts.join(asked, texts["_key"].eqNullSafe(asked["_key"]) & (texts["_sha"] == asked["_sha"]))
    sets = full_sets(texts.select("_class", "_text"), "_text", shingle).dropDuplicates(["_class"])
    sets = materialize(sets, "full-sets")

    few = members.filter(F.col("_count") <= SMALL).groupBy("_meet").agg(F.sort_array(F.collect_list("_class")).alias("_all"))
    few = few.select(F.explode("_all").alias("a"), "_all").select("a", F.explode("_all").alias("b")).filter("a < b")
    many = members.filter((F.col("_count") > SMALL) & (F.col("_class") > F.col("_least")))
    pairs = few.unionByName(many.select(F.col("_least").alias("a"), F.col("_class").alias("b"))).distinct()
    links = materialize(verify(pairs, classes, sets, percent, batch, miss), "links")
    roots = components(links, "a", "b")

    still, stored = _still_open(members, roots, sets, classes, percent)
    more = materialize(_block_links(materialize(still, "open"), percent, batch, miss), "links")
    if more.limit(1).count():
        roots = components(links.unionByName(more), "a", "b")
    release(members, sets, *stored)

    # the least id of a component
    rooted = named.join(roots, named["_class"] == roots["node"], "left")
    rooted = materialize(rooted.select("_set", "_least", F.coalesce("root", "_class").alias("_root")), "rooted")
    joint = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    joint = materialize(rooted.join(joint, "_root").select("_set", "component_id"), "components")
    release(named, classes, links, more, rooted)
    alone = F.col("_n") == 0
    out = sketched.select("_key", "_n", "_set").join(joint, "_set", "left")
    component = F.when(alone, F.col("_key")).otherwise(F.col("component_id"))
    return out.select(
        F.col("_key").alias(key),
        F.col("_n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("_key").eqNullSafe(component).alias("kept"),
    )
