"""Bands, region names, title case and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_col, null_if_any

# Fixed values the results are labelled with.
SCORE_EDGES = (25, 50, 75, 100)
SCORE_BANDS = ("1-25", "26-50", "51-75", "76-100")
ERA_EDGES = (1929, 1959, 1989, 2030)
ERAS = ("pre-1930", "1930-59", "1960-89", "1990+")
REGIONS = {
    "1": "Manhattan",
    "2": "Bronx",
    "3": "Brooklyn",
    "4": "Queens",
    "5": "Staten Island",
}
SIZE_LABELS = {1: "Smallest 25%", 2: "Small-mid", 3: "Mid-large", 4: "Largest 25%"}
QCUT_LABELS = ("smallest 25%", "small-mid", "mid-large", "largest 25%")
NO_HEAT = ("NO HEAT", "NO HEAT AND NO HOT WATER")
HEAT_TYPE = "HEAT/HOT WATER"
MISSING = "Not Available"
# Characters after which title case starts a new word, besides white space.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+*%/|\\\[\](){}<>-"""


def band(
    c: Column | str,
    edges: Sequence[float],
    labels: Sequence[str],
    low: float | None = None,
    low_inclusive: bool = False,
    open_top: bool = True,
) -> Column:
    """Right-closed bands. ``low`` bounds the first band; ``open_top`` drops the last edge."""
    value = as_col(c)
    in_range = value.isNotNull()
    if low is not None:
        in_range = in_range & ((value >= low) if low_inclusive else (value > low))
    chain = None
    for i, (edge, label) in enumerate(zip(edges, labels, strict=True)):
        cond = in_range if open_top and i == len(labels) - 1 else in_range & (value <= edge)
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    return chain


def score_band(c: Column | str) -> Column:
    return band(c, SCORE_EDGES, SCORE_BANDS)


def score_band_cut(c: Column | str) -> Column:
    """Closed variant: values outside 0 to 100 have no band."""
    return band(c, SCORE_EDGES, SCORE_BANDS, low=0, low_inclusive=True, open_top=False)


def era(c: Column | str) -> Column:
    return band(c, ERA_EDGES, ERAS, low=0)


def era_cut(c: Column | str) -> Column:
    """Closed variant: years past the last edge have no era."""
    return band(c, ERA_EDGES, ERAS, low=0, open_top=False)


def ordinal(c: Column | str, labels: Sequence[str]) -> Column:
    """1-based position of a label, to sort labels in their natural order."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), as_col(c))
    return F.when(pos > 0, pos.cast("int"))


def label_of(c: Column | str, mapping: dict) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), as_col(c))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter of every word; punctuation breaks words too."""
    words = F.regexp_extract_all(
        F.lower(as_col(c)), F.lit(rf"[^\s{WORD_BREAKS}]+|[\s{WORD_BREAKS}]+"), F.lit(0)
    )
    return F.array_join(F.transform(words, F.initcap), "")


def region_name(key: Column | str, fallback: Column | str | None = None) -> Column:
    """Region by the key's first digit, else the cleaned fallback text, else 'Unknown'."""
    text = F.lit(None).cast("string") if fallback is None else as_col(fallback)
    by_digit = label_of(F.substring(as_col(key), 1, 1), REGIONS)
    return F.coalesce(by_digit, title_case(null_if_any(text, "Unspecified", "")), F.lit("Unknown"))


def rate(n: Column | str, area: Column | str, per: float = 100_000) -> Column:
    """Events per ``per`` units of area; NULL unless the area is positive."""
    n, area = as_col(n), as_col(area)
    return F.when(area > 0, n / area * per)


def snap(c: Column | str, cell: float) -> Column:
    """Nearest grid line, rounded to 4 decimals."""
    return F.round(F.round(as_col(c) / cell) * cell, 4)


def fraction_of(cond: Column) -> Column:
    """Share of rows for which ``cond`` holds."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))
