"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

Texts and test items are compared as words: runs of letters and digits, lower-cased.
In scripts without blanks (Chinese, Japanese, Thai, Lao, Burmese, Khmer) each letter is a word.
An item of n words may differ by a budget of ``rate * n`` inserted, missing or changed
words. It is split into one piece more than the budget, so that at least one piece of
any occurrence is intact; an item too short for an error is one piece and has to be there
word by word. Around each exact piece hit, Myers' algorithm (with words as its alphabet) gives
the least distance of the whole item to any stretch of the text, which decides.

Items stay in tables. One pass over the texts hashes their runs of as many words as pieces
have, and keeps those runs that a bit map of all pieces, of fixed size, may hold. These meet the
pieces in a join, and the texts in which something met are verified, each once for all its
copies. Neither driver nor tasks ever hold the items.

Defined cases: a null or wordless text holds no item; an item without words is never
found; repeated items and rows are all reported; items without an id are left out; empty
tables give no matches; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, release
from .common import arrow_rows, free_name

RATE = 0.2
MAP_BITS = 1 << 24  # of the bit map of pieces; more pieces only let more runs through
KNOWN_WORDS = 300_000  # word hashes that a task remembers at once
TOGETHER = 16  # a text's items are verified in so many parts
FACTOR = 0x9E3779B97F4A7C15
MATCH = "array<struct<item_id: bigint, distance: int, first_word: int, last_word: int>>"
# Thai, Lao; Burmese; Khmer; kana; ideographs; half-width kana; rare ideographs
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001aff0-\U0001b16f\U00020000-\U000323af"
_WORD = re.compile(rf"[^\W_{_UNSPACED}]+|[^\W_]")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(unicodedata.normalize("NFC", text).lower()) if text else []


def budget(words: int, rate: float = RATE) -> int:
    """Errors allowed; always fewer than the words, so that no piece is empty."""
    return min(int(words * rate), max(words - 1, 0))


def pieces(words: list[str], errors: int) -> list[tuple[int, list[str]]]:
    """``errors + 1`` pieces of nearly equal length with their first positions."""
    cuts = [round(i * len(words) / (errors + 1)) for i in range(errors + 2)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


def pattern_bits(words: list[str]) -> dict[str, int]:
    bits: dict[str, int] = defaultdict(int)
    for i, word in enumerate(words):
        bits[word] |= 1 << i
    return dict(bits)


def least_distance(bits: dict[str, int], length: int, text: list[str]) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of ``text``, and the word after the first such end."""
    mask, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = mask, 0, length
    best, end = length, 0
    for i, word in enumerate(text):
        match = bits.get(word, 0)
        cross = match | minus
        diagonal = (((match & plus) + plus) ^ plus) | match
        up, down = minus | (~(diagonal | plus) & mask), plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        # a stretch may start anywhere, so the top row stays 0
        up, down = (up << 1) & mask, (down << 1) & mask
        plus, minus = down | (~(cross | up) & mask), up & cross
        if score < best:
            best, end = score, i + 1
    return best, end


class Hasher:
    """64-bit hashes of words and of their runs."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known = self.known
        for word in {w for w in words if w not in known}:
            known[word] = int.from_bytes(blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    @staticmethod
    def runs(hashes: np.ndarray, size: int) -> np.ndarray:
        """Of every run of ``size`` words."""
        count = len(hashes) - size + 1
        if count < 1:
            return np.zeros(0, np.uint64)
        total, factor = np.full(count, size, np.uint64), 1
        for i in range(size):
            factor = factor * FACTOR % (1 << 64)
            total += hashes[i : i + count] * np.uint64(factor | 1)
        total ^= total >> np.uint64(32)
        total *= np.uint64(FACTOR)
        return total ^ (total >> np.uint64(29))


def nearest(words: list[str], item: list[str], errors: int, spans: list[tuple[int, int]]) -> tuple[int, int, int] | None:
    """Distance, first and last word of the item's nearest occurrence within its budget around ``spans``."""
    merged: list[list[int]] = []
    for low, high in sorted(spans):
        low, high = max(0, low), min(len(words), high)
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    bits, best = pattern_bits(item), None
    for low, high in merged:
        distance, end = least_distance(bits, len(item), words[low:high])
        if distance <= errors and (best is None or distance < best[0]):
            best = (distance, low, low + end)
    if best is None:
        return None
    distance, low, end = best
    first = max(low, end - len(item) - errors)
    # the item read backwards from its end tells where it begins
    _, taken = least_distance(pattern_bits(item[::-1]), len(item), words[first:end][::-1])
    return distance, end - taken, end - 1


def cut_items(items: DataFrame, key: str, text: str, rate: float = RATE) -> DataFrame:
    """Rows (_item, _id, _words, _errors, _starts, _sizes, _hashes) of the items that have words."""
    named = items.select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"))
    named = named.filter("_id is not null and _text is not null").withColumn("_item", F.monotonically_increasing_id())

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for part in parts:
            rows = []
            for item, own_id, body in zip(part["_item"], part["_id"], part["_text"]):
                words = words_of(body)
                if words:
                    errors = budget(len(words), rate)
                    cuts = pieces(words, errors)
                    hashes = [int(Hasher.runs(hasher.words(p), len(p)).view(np.int64)[0]) for _, p in cuts]
                    rows.append((item, own_id, words, errors, [a for a, _ in cuts], [len(p) for _, p in cuts], hashes))
            yield pd.DataFrame(rows, columns=["_item", "_id", "_words", "_errors", "_starts", "_sizes", "_hashes"])

    kinds = "_item long, _id long, _words array<string>, _errors int, _starts array<int>, _sizes array<int>, _hashes array<long>"
    return named.mapInPandas(cut, kinds)


def piece_map(pieces_: DataFrame, bits: int = MAP_BITS) -> np.ndarray:
    """A bit map with the bit of each piece's hash set; ``bits`` bits however many pieces there are."""
    place = F.pmod("_hash", F.lit(bits))
    cells = pieces_.groupBy(F.floor(place / 64).alias("cell")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits")
    )
    found = np.zeros(bits // 64, np.uint64)
    for cell, value in cells.collect():  # at most bits / 64 rows
        found[cell] = value % (1 << 64)
    return found


def _texts_with_hits(docs: DataFrame, sha: str, text: str, sizes: list[int], held: np.ndarray) -> DataFrame:
    """Rows (_sha, _text, _hash, _at) of the texts with runs that the map lets through; the last two are arrays."""
    cells, total = np.uint64(len(held)), np.uint64(len(held) * 64)

    def hits(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for part in parts:
            rows = []
            for own, body in zip(part["_sha"], part["_text"]):
                hashes, found, at = hasher.words(words_of(body)), [], []
                for size in sizes:
                    runs = Hasher.runs(hashes, size)
                    place = runs % total
                    inside = np.flatnonzero((held[(place >> np.uint64(6)) % cells] >> (place & np.uint64(63))) & np.uint64(1))
                    if len(inside):
                        found.append(runs[inside].view(np.int64))
                        at.append(inside.astype(np.int32))
                if found:
                    rows.append((own, body, np.concatenate(found), np.concatenate(at)))
            yield pd.DataFrame(rows, columns=["_sha", "_text", "_hash", "_at"])

    kinds = "_sha binary, _text string, _hash array<long>, _at array<int>"
    return docs.select(F.col(sha).alias("_sha"), F.col(text).alias("_text")).filter("_text is not null").mapInPandas(hits, kinds)


def _verify(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = []
        for own, body, wanted in zip(part["_sha"], part["_text"], part["_wanted"]):
            words = words_of(body)
            for one in wanted:
                item = list(one["_words"])
                spans = [(s["low"], s["high"]) for s in one["_spans"]]
                if match := nearest(words, item, one["_errors"], spans):
                    rows.append((own, one["_id"], *match))
        yield pd.DataFrame(rows, columns=["_sha", "item_id", "distance", "first_word", "last_word"])


def find(docs: DataFrame, sha: str, text: str, items: DataFrame, item_key: str, item_text: str, rate: float = RATE) -> DataFrame:
    """Rows (_sha, item_id, distance, first_word, last_word), one per text that differs and item found in it.

    ``sha`` names a binary column that is equal for equal texts.
    """
    cut = materialize(cut_items(items, item_key, item_text, rate), "items")
    sizes = sorted(r[0] for r in cut.select(F.explode("_sizes")).distinct().collect())  # at most 1 / rate + 1
    spread = cut.select("_item", "_errors", F.size("_words").alias("_n"), F.explode(F.arrays_zip("_starts", "_hashes")).alias("p"))
    cuts = spread.select("_item", "_errors", "_n", F.col("p._starts").alias("_start"), F.col("p._hashes").alias("_hash"))
    held = piece_map(cuts)
    with arrow_rows(docs.sparkSession):
        texts = materialize(_texts_with_hits(docs, sha, text, sizes, held).dropDuplicates(["_sha"]), "texts-with-hits")

    hits = texts.select("_sha", F.explode(F.arrays_zip("_hash", "_at")).alias("h"))
    hits = hits.select("_sha", F.col("h._hash").alias("_hash"), F.col("h._at").alias("_at"))
    before = F.col("_at") - F.col("_start")
    span = F.struct((before - F.col("_errors")).alias("low"), (before + F.col("_n") + F.col("_errors")).alias("high"))
    pairs = hits.join(cuts, "_hash").groupBy("_sha", "_item").agg(F.collect_list(span).alias("_spans"))
    wanted = pairs.join(cut.select("_item", "_id", "_words", "_errors"), "_item")
    part = F.pmod(F.xxhash64("_item"), F.lit(TOGETHER)).alias("_part")
    listed = wanted.groupBy("_sha", part).agg(F.collect_list(F.struct("_id", "_words", "_errors", "_spans")).alias("_wanted"))
    found = texts.select("_sha", "_text").join(listed, "_sha").select("_sha", "_text", "_wanted")
    matches = found.mapInPandas(_verify, "_sha binary, item_id long, distance int, first_word int, last_word int")
    with arrow_rows(docs.sparkSession):
        out = materialize(matches, "found-items")
    release(cut, texts)
    return out


def with_matches(docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, name: str, rate: float = RATE) -> DataFrame:
    """``docs`` with an array ``name`` of the items found in each text."""
    sha = free_name(docs, "_sha")
    hashed = docs.withColumn(sha, F.unhex(F.sha2(F.col(text), 256)))
    found = find(hashed, sha, text, items, item_key, item_text, rate)
    match = F.struct("item_id", "distance", "first_word", "last_word")
    listed = found.groupBy("_sha").agg(F.sort_array(F.collect_list(match)).cast(MATCH).alias("_matches"))
    listed = listed.select(F.col("_sha").alias(f"{sha}_of"), F.col("_matches").alias(f"{name}_of"))
    joined = hashed.join(listed, F.col(sha) == F.col(f"{sha}_of"), "left")
    matches = F.coalesce(F.col(f"{name}_of"), F.array().cast(MATCH)).alias(name)
    return joined.select(*[hashed[c] for c in docs.columns if c != name], matches)
