"""The raw inputs, derived from the driver's order and part tables.

Orders stand in for complaints, parts for properties; customers and parts with
equal keys share a lot, so lots without any order are the zero-count controls.
All payload fields are text, as the source sends them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_label
from ..functions.casts import iso_text

FIRST_LOAD = "2001-09-01"
SECOND_LOAD = "2001-09-03"
FIRST_YEAR, LAST_YEAR = 1993, 1997
DAILY_FILE = "dt=2001-09-03"
PARTS_PER_TASK = 50_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame, rows: int = PARTS_PER_TASK) -> DataFrame:
    """``df`` in as many partitions as it has ``rows``, however few files and row groups hold it.

    The count comes from the files' footers. Rows are dealt in turn, so that no key gathers them.
    """
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def _shift(c: Column, seconds: Column) -> Column:
    return c + seconds * F.expr("interval '1' second")


def _lot(n: Column) -> tuple[Column, Column, Column]:
    text = lambda c: c.cast("string")
    return text(n % 5 + 1), text(n % 100000), text(n % 97)


def _clean(n: Column) -> Column:
    region, block, lot = _lot(n)
    return F.concat(region, F.lpad(block, 5, "0"), F.lpad(lot, 4, "0"))


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaint versions: a monthly first load, then a daily file.

    The daily file republishes open complaints as closed (newer version) and
    re-sends pending ones unchanged (same version, later file).
    """
    orders = read(spark, sf_dir, "orders")
    shipped = (
        read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    k, cust = F.col("o_orderkey"), F.col("o_custkey")
    detail = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "NO HEAT")
        .when(F.col("o_orderpriority") == "2-HIGH", "NO HEAT AND NO HOT WATER")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "NO HOT WATER")
        .when(F.col("o_orderpriority") == "5-LOW", "HEAT ON IN SUMMER")
    )
    status = F.col("o_orderstatus")
    base = orders.join(shipped, "o_orderkey", "left").select(
        k.cast("string").alias("unique_key"),
        iso_text(_shift(F.col("o_orderdate"), k * 7919 % 86400)).alias("created_date"),
        iso_text(_shift(F.col("shipped"), k * 104729 % 86400)).alias("closed_date"),
        F.when(status == "F", "Closed").when(status == "O", "Open").otherwise("Pending").alias("status"),
        F.when(F.col("o_totalprice") < 20000, "PLUMBING").otherwise("HEAT/HOT WATER").alias("complaint_type"),
        detail.alias("descriptor_2"),
        F.when(status == "F", "STATEN ISLAND")
        .when(status == "O", "Unspecified")
        .otherwise("")
        .alias("borough"),
        F.when(cust % 53 == 0, "Unspecified").otherwise(_clean(cust)).alias("bbl"),
        (F.lit(40.3) + (cust % 800) * 0.001).cast("string").alias("latitude"),
        (F.lit(-74.4) + (k % 900) * 0.001).cast("string").alias("longitude"),
        month_label("o_orderdate").alias("_month"),
        status.alias("_code"),
    )
    # one pass over the joined rows: each row yields its one or two versions
    first = F.struct(
        "status",
        F.lit(f"{FIRST_LOAD}T00:00:00Z").alias(":updated_at"),
        F.concat(F.lit("created_month="), F.col("_month")).alias("source_file"),
        F.lit(FIRST_LOAD).cast("timestamp_ntz").alias("loaded_at"),
    )
    again = F.struct(
        F.when(F.col("_code") == "O", "Closed").otherwise(F.col("status")).alias("status"),
        F.when(F.col("_code") == "O", f"{SECOND_LOAD}T00:00:00Z")
        .otherwise(f"{FIRST_LOAD}T00:00:00Z")
        .alias(":updated_at"),
        F.lit(DAILY_FILE).alias("source_file"),
        F.lit(SECOND_LOAD).cast("timestamp_ntz").alias("loaded_at"),
    )
    versions = F.when(F.col("_code") == "F", F.array(first)).otherwise(F.array(first, again))
    return (
        base.withColumn("_v", F.explode(versions))
        .drop("status", "_month", "_code")
        .select("*", "_v.*")
        .drop("_v")
    )


def raw_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property rows of five report years, with every identifier format met in practice.

    Adds repeated properties in the early years (older report, must lose) and
    a stale first load of the 1996 file (newer report date, must lose too).
    A part becomes five and more wide rows, so the parts are spread before.
    """
    k = F.col("p_partkey")
    region, block, lot = _lot(k)
    clean, nxt = _clean(k), _clean(k + 1)
    kind = k % 12
    key = (
        F.when(kind == 0, F.concat_ws("-", region, block, lot))
        .when(kind == 5, F.concat_ws("; ", clean, nxt))
        .when(kind == 1, F.concat_ws(", ", clean, nxt))
        .when(kind == 2, "0000000001, 0000000002")
        .when(kind == 3, "Not Available")
        .when(kind == 4, "1-2-3-4")
        .when(kind == 7, F.concat(region, F.lit("/"), block))
        .otherwise(clean)
    )
    built = (1900 + k % 125).cast("string")
    base = (
        spread(read(spark, sf_dir, "part"))
        .withColumn("year", F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR))))
        .select(
            F.col("year").cast("string").alias("report_year"),
            k.cast("string").alias("property_id"),
            F.col("p_name").alias("property_name"),
            key.alias("nyc_borough_block_and_lot"),
            F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), "Office")
            .otherwise("Multifamily Housing")
            .alias("primary_property_type"),
            F.when(k % 9 == 0, "Not Available")
            .otherwise((F.col("p_size") * 2).cast("string"))
            .alias("energy_star_score"),
            F.when(k % 31 == 0, "Not Available")
            .when(k % 37 == 0, "0")
            .when(k % 29 == 0, F.concat(built, F.lit(".5")))
            .otherwise(built)
            .alias("year_built"),
            F.when(k % 41 == 0, "0")
            .otherwise((F.col("p_retailprice") * 100).cast("long").cast("string"))
            .alias("property_gfa_self_reported"),
            F.concat_ws(" ", k.cast("string"), F.col("p_name"), F.lit("st-east")).alias("address_1"),
            F.col("p_brand").alias("_brand"),
        )
    )

    def version(report: str, loaded: str, score: Column) -> Column:
        return F.struct(
            score.alias("energy_star_score"),
            F.lit(report).alias("report_generation_date"),
            F.lit(loaded).cast("timestamp_ntz").alias("loaded_at"),
        )

    score = F.col("energy_star_score")
    current = version("2001-01-15T00:00:00", "2001-09-02", score)
    repeated = version("2000-12-01T00:00:00", "2001-09-02", F.lit("1"))
    stale = version("2001-02-01T00:00:00", "2001-08-01", F.lit("50"))
    early = F.col("report_year") < "1996"
    versions = (
        F.when(early & F.col("_brand").isin("Brand#7", "Brand#8"), F.array(current, repeated))
        .when(F.col("report_year") == "1996", F.array(current, stale))
        .otherwise(F.array(current))
    )
    return (
        base.withColumn("_v", F.explode(versions))
        .drop("energy_star_score", "_brand")
        .select(
            "*",
            "_v.*",
            F.lit("2001-09-01T00:00:00Z").alias(":updated_at"),
            F.concat(F.lit("report_year="), F.col("report_year")).alias("source_file"),
        )
        .drop("_v")
    )


def as_variant(raw: DataFrame) -> DataFrame:
    """The landing form: one semi-structured record plus lineage."""
    payload = [c for c in raw.columns if c not in ("source_file", "loaded_at")]
    record = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in payload]))
    return raw.select(record.alias("record"), "source_file", "loaded_at")
