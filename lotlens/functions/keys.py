"""Lot keys: ten digits, made of region (1), block (5) and lot (4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_col

# The accepted key format and the separators seen in key lists.
KEY_PATTERN = r"^[1-5][0-9]{9}\z"
SEPARATORS = "[;,]"
BLOCK_DIGITS = 5
LOT_DIGITS = 4


def _zero_fill(part: Column, width: int) -> Column:
    # lpad alone would cut longer parts; those must stay long and fail validation
    return F.when(F.length(part) < width, F.lpad(part, width, "0")).otherwise(part)


def normalize_key(c: Column | str) -> Column:
    """Dashed region-block-lot to ten digits; other dash counts give NULL; no dash is kept."""
    piece = as_col(c)
    parts = F.split(piece, "-")
    joined = F.concat(
        F.get(parts, F.lit(0)),
        _zero_fill(F.get(parts, F.lit(1)), BLOCK_DIGITS),
        _zero_fill(F.get(parts, F.lit(2)), LOT_DIGITS),
    )
    return F.when(F.size(parts) == 1, piece).when(F.size(parts) == 3, joined)


def valid_key(c: Column | str) -> Column:
    return as_col(c).rlike(KEY_PATTERN)


def key_or_null(c: Column | str) -> Column:
    key = as_col(c)
    return F.when(valid_key(key), key)


def key_pieces(c: Column | str, separators: str = SEPARATORS) -> Column:
    pieces = F.split(F.coalesce(as_col(c), F.lit("")), separators)
    return F.transform(pieces, lambda piece: F.trim(piece))


def lot_keys(c: Column | str) -> Column:
    """Array of the distinct valid keys in one free-text field.

    Nearly all fields hold one clean key; those skip the array work.
    """
    raw = as_col(c)
    normalized = F.transform(key_pieces(raw), normalize_key)
    return F.when(valid_key(raw), F.array(raw)).otherwise(
        F.array_distinct(F.filter(normalized, valid_key))
    )


def surrogate_key(*cols: Column | str) -> Column:
    """Parts joined by '-'; NULL when any part is NULL."""
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit("-"))
        parts.append(as_col(c).cast("string"))
    return F.concat(*parts)
