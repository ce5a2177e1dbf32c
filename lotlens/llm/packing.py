"""Packing of tokenised texts into sequences by non-negative least squares.

A text is cut at every full window; what remains is its rest. Rests are put into
classes of nearly equal length. All combinations of at most three classes that fill a
window are enumerated, and non-negative least squares finds how often to repeat each so
that the histogram of the rests is used up. The repeat counts are rounded down to what
is there. The planner sees only the histogram (window / STEP classes).

Rests that no repeat takes are cut into their binary blocks (1,300 is 1,024 + 256 + 16
+ 4). Blocks are laid out greedily, the largest first: powers of two fill windows
without a gap, and the few left at the end form sequences that are powers of two.

Checksums of rests and of their blocks are taken when a text is tokenised, so texts are
tokenised once and tokens are never shuffled.

Ids are those of the ``tokenizers`` file. A faster encoder with the same vocabulary and
merges is used where both provably read a text alike: plain Latin text without special
tokens or very long runs. All other texts go through ``tokenizers`` itself.

Defined cases: a null text counts as empty and gives the end id alone; repeated rows
are each packed; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import arrow_rows, numbered, small_table

WINDOW = 2048
STEP = 8  # lengths of one class differ by less
DEPTH = 3  # rests in a combination
END = 1
VOCABULARY = "byte_bpe_50k"
#: Texts for the faster encoder: characters below U+0180, no special token, no run of 400 or more of one kind.
_PLAIN = re.compile(r"[\x00-ſ]*")
_RUN = 400
_BLANKS = re.compile(rf"\s{{{_RUN}}}")
_SOME_BLANKS = re.compile(rf"\s{{{_RUN // 100}}}")

CUT = "doc_id bigint, doc_tokens bigint, full array<bigint>, rest int, rest_crc bigint, blocks array<bigint>"


def encoders(vocabulary: str = VOCABULARY):
    """The tokenizer itself, and the faster encoder of the same vocabulary."""
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs several tasks beside each other
    exact = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, fast


def has_long_run(text: str) -> bool:
    """Whether the text has _RUN or more characters in a row that are all blank or all not.

    A search for both kinds from every character took a quarter of the time of all ids.
    """
    if max(map(len, text.split()), default=0) >= _RUN:
        return True
    # so many blanks in a row are met by as many of every 100th character
    return _SOME_BLANKS.search(text[::100]) is not None and _BLANKS.search(text) is not None


def token_ids(text: str | None, exact, fast) -> np.ndarray:
    """Ids of ``text`` and the end id, as little-endian unsigned 32-bit numbers."""
    text = text or ""
    if "<|" not in text and _PLAIN.fullmatch(text) and not has_long_run(text):
        ids = fast.encode_to_numpy(text, disallowed_special=())
    else:
        ids = exact.encode(text, add_special_tokens=False).ids
    return np.append(np.asarray(ids, "<u4"), np.array([END], "<u4"))


def binary_blocks(length: int) -> list[int]:
    """The powers of two that sum to ``length``, the largest first."""
    return [1 << i for i in reversed(range(length.bit_length())) if length >> i & 1]


def cut(ids: np.ndarray, window: int = WINDOW) -> tuple[list[int], int, int | None, list[int]]:
    """Checksums of the full windows, length and checksum of the rest, checksums of its blocks."""
    full = len(ids) // window
    rest = ids[full * window :]
    ends = np.cumsum(binary_blocks(len(rest))).tolist()
    return (
        [zlib.crc32(ids[i * window : (i + 1) * window].tobytes()) for i in range(full)],
        len(rest),
        zlib.crc32(rest.tobytes()) if len(rest) else None,
        [zlib.crc32(rest[a:b].tobytes()) for a, b in zip([0, *ends], ends)],
    )


def tokenised(docs: DataFrame, key: str, text: str, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        exact, fast = encoders(vocabulary)  # once a task
        for batch in batches:
            rows = []
            for doc_id, body in zip(batch["doc_id"], batch["text"]):
                ids = token_ids(body, exact, fast)
                rows.append((doc_id, len(ids), *cut(ids, window)))
            yield pd.DataFrame(rows, columns=["doc_id", "doc_tokens", "full", "rest", "rest_crc", "blocks"]).astype(
                {"doc_id": "Int64", "rest_crc": "Int64"}
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, CUT)


def combinations(classes: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Class numbers (a class holds lengths up to number * STEP) that together fill a window."""
    found = [(classes,)]
    for n in range(2, depth + 1):
        for first in combinations_with_replacement(range(1, classes), n - 1):
            last = classes - sum(first)
            if last >= first[-1]:
                found.append((*first, last))
    return found


def nnls(matrix: np.ndarray, target: np.ndarray, most: int | None = None) -> np.ndarray:
    """Non-negative least squares by an active set (Lawson and Hanson)."""
    columns = matrix.shape[1]
    x, active = np.zeros(columns), np.zeros(columns, bool)
    tolerance = 1e-9 * max(1.0, np.abs(target).max(initial=0.0))
    for _ in range(most or 3 * matrix.shape[0]):
        gain = matrix.T @ (target - matrix @ x)
        gain[active] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            part = matrix[:, at]
            # the ridge only settles combinations that say the same
            solved = np.linalg.solve(part.T @ part + 1e-9 * np.eye(len(at)), part.T @ target)
            if solved.min() > 0:
                x[:] = 0
                x[at] = solved
                break
            falling = solved <= 0
            share = (x[at][falling] / np.maximum(x[at][falling] - solved[falling], 1e-300)).min()
            x[at] += share * (solved - x[at])
            active &= x > tolerance * 1e-3
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(histogram: dict[int, int], classes: int, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """Combinations with their repeat counts; never more than the histogram (class: rests) holds."""
    left = np.zeros(classes + 1, np.int64)
    for number, count in histogram.items():
        left[number] = count
    choices = [c for c in combinations(classes, depth) if all(left[n] for n in c)]
    if not choices:
        return []
    matrix = np.zeros((classes + 1, len(choices)))
    for j, choice in enumerate(choices):
        for n in choice:
            matrix[n, j] += 1
    repeats = nnls(matrix, left.astype(float))
    chosen = []
    for j in np.argsort(-repeats, kind="stable"):
        if repeats[j] <= 0:
            break
        need = matrix[:, j].astype(np.int64)
        used = need > 0
        count = min(int(round(repeats[j])), int((left[used] // need[used]).min()))
        if count:
            left -= need * count
            chosen.append((choices[j], count))
    return chosen


def pack(docs: DataFrame, key: str, text: str, *, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if window & (window - 1) or window < STEP:
        raise ValueError(f"the window must be a power of two of at least {STEP}")
    spark, classes = docs.sparkSession, window // STEP
    with arrow_rows(spark):
        texts = materialize(tokenised(docs, key, text, window, vocabulary), "tokenised")
    rests = texts.filter("rest > 0").select(
        "doc_id",
        "doc_tokens",
        (F.col("doc_tokens") - F.col("rest")).alias("start"),
        F.col("rest").cast("long").alias("length"),
        F.col("rest_crc").alias("ids_crc32"),
        "blocks",
        F.ceil(F.col("rest") / STEP).cast("int").alias("_class"),
    )
    histogram = {r[0]: r[1] for r in rests.groupBy("_class").count().collect()}
    chosen = plan(histogram, classes)
    spans, taken, base = [], dict.fromkeys(histogram, 0), 0
    for combination, count in chosen:
        for slot, number in enumerate(combination):
            spans.append((number, taken[number], taken[number] + count, base, slot))
            taken[number] += count
        base += count
    slots = small_table(spark, spans, "_class int, _from long, _to long, _base long, _slot int")
    ranked = numbered(rests, ["_class"], ["doc_id", "ids_crc32"], "_rank")
    placed = ranked.join(
        F.broadcast(slots),  # a class is in a few combinations: some thousand rows, set by the window
        (ranked["_class"] == slots["_class"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
        "left",
    )
    placed = materialize(placed.drop("_class"), "placed")
    piece = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    along = F.expr(
        "sum(length) over (partition by sequence_id order by _slot rows between unbounded preceding and 1 preceding)"
    )
    combined = (
        placed.filter("_base is not null")
        .withColumn("sequence_id", F.col("_base") + F.col("_rank") - F.col("_from"))
        .select(*piece, "sequence_id", F.coalesce(along, F.lit(0)).cast("long").alias("offset"))
    )
    # rests that no combination takes, in their binary blocks
    powers_of_two = F.array(*[F.lit(n).cast("long") for n in binary_blocks(window - 1)])
    sizes = F.filter(powers_of_two, lambda n: F.col("length").bitwiseAND(n) != 0)
    block = F.transform(
        "_sizes", lambda size, i: F.struct(size.alias("size"), F.get("blocks", i).alias("crc"), i.alias("at"))
    )
    earlier = F.aggregate(F.slice("_sizes", F.lit(1), F.col("_block.at")), F.lit(0).cast("long"), lambda a, x: a + x)
    loose = (
        placed.filter("_base is null")
        .withColumn("_sizes", sizes)
        .withColumn("_block", F.explode(block))
        .select(
            "doc_id",
            (F.col("start") + earlier).alias("start"),
            F.col("_block.size").alias("length"),
            F.col("_block.crc").alias("ids_crc32"),
            "doc_tokens",
        )
    )
    whole = texts.select("doc_id", "doc_tokens", F.posexplode("full").alias("_at", "ids_crc32")).select(
        "doc_id",
        (F.col("_at") * F.lit(window)).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
    )
    powers = materialize(whole.unionByName(loose), "powers")
    counts = {r[0]: r[1] for r in powers.groupBy("length").count().collect()}
    # laid end to end, the largest first, powers of two never straddle a window
    starts, at = [], base * window
    for length in sorted(counts, reverse=True):
        starts.append((length, at))
        at += length * counts[length]
    before = small_table(spark, starts, "length long, _start long")
    laid = (
        numbered(powers, ["length"], ["doc_id", "start", "ids_crc32"], "_rank")
        .join(F.broadcast(before), "length")  # one row per power of two
        .withColumn("_at", F.col("_start") + F.col("_rank") * F.col("length"))
        .select(
            *piece,
            F.expr(f"_at div {window}").cast("long").alias("sequence_id"),
            (F.col("_at") % window).cast("long").alias("offset"),
        )
    )
    return combined.unionByName(laid)
