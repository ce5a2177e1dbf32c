"""Published JSON: column-oriented objects for small aggregates, row files for lots."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import iso_text


def plain(field: T.StructField) -> Column:
    """A value as JSON holds it: whole decimals as long, others as double, dates as ISO text."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        return c.cast("long" if field.dataType.scale == 0 else "double").alias(field.name)
    if isinstance(field.dataType, T.DateType):
        return c.cast("string").alias(field.name)
    if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
        return iso_text(c).alias(field.name)
    return c.alias(field.name)


def to_columnar(
    df: DataFrame, order: Sequence[str], per: Sequence[str] = (), decimals: bool = False
) -> DataFrame:
    """One row of equally long arrays, one per column, sorted by ``order``.

    For aggregates of bounded size only (days x regions, seasons x regions).
    ``per`` makes one such row per key. ``decimals`` leaves those as they are. Values are collected as structs, so
    NULLs keep their place.
    """
    fields = [f for f in df.schema.fields if f.name not in per]
    rest = [f.name for f in fields if f.name not in order]
    row = F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]])
    kept = lambda f: decimals and isinstance(f.dataType, T.DecimalType)
    shown = [F.col(f"`{f.name}`") if kept(f) else plain(f) for f in fields]
    packed = df.select(*per, *shown).groupBy(*per).agg(
        F.array_sort(F.collect_list(row)).alias("_rows")
    )
    return packed.select(
        *per, *[F.col("_rows").getField(f.name).alias(f.name) for f in fields]
    )


def from_columnar(df: DataFrame) -> DataFrame:
    """The rows of a columnar object."""
    zipped = F.arrays_zip(*[F.col(f"`{c}`") for c in df.columns])
    row = df.select(F.explode(zipped).alias("r"))
    return row.select(*[F.col("r").getField(c).alias(c) for c in df.columns])


def _decimals(values: Column) -> Column:
    """A JSON array of decimals, each written by its value: 5.00 is 5, 5.20 is 5.2."""
    digits = lambda v: F.regexp_replace(v.cast("string"), r"(\.\d*?)0+$", "$1")
    texts = F.transform(values, lambda v: F.coalesce(F.regexp_replace(digits(v), r"\.$", ""), F.lit("null")))
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def columnar_json(df: DataFrame, order: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """The columnar object as compact JSON text."""
    wide = to_columnar(df, order, per, decimals=True)
    members = []
    for f in wide.schema.fields:
        if f.name not in per:
            c = F.col(f"`{f.name}`")
            kind = f.dataType.elementType
            # to_json of a one-member object, without its braces
            plain_json = F.expr(f"substring(to_json(named_struct('v', `{f.name}`), map('ignoreNullFields', 'false')), 6)")
            body = _decimals(c) if isinstance(kind, T.DecimalType) else F.rtrim(plain_json, F.lit("}"))
            members.append(F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ":"), body))
    value = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return wide.select(*per, value.alias("value"))


def write_columnar(df: DataFrame, order: Sequence[str], path: str) -> None:
    columnar_json(df, order).write.mode("overwrite").text(path)


def write_per_season(lots: DataFrame, path: str) -> None:
    """One folder of row-oriented JSON per season, all written by one job.

    A season's lots grow with the data, so they are split over several files
    of bounded size instead of one object.
    """
    spread = lots.repartitionByRange("heat_season", "bbl").sortWithinPartitions("heat_season", "bbl")
    spread.write.mode("overwrite").option("maxRecordsPerFile", 1_000_000).partitionBy(
        "heat_season"
    ).json(path)
