"""Raw landing zone: idempotent partition writes and a ledger-driven file load."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from hashlib import sha256
from itertools import islice

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import month_label
from ..operators.profile import counts_by
from .extract import between_half_open, extract_since, land, month_windows
from .files import folders, tail
from .state import Bookmark, read_or_empty

NESTED = (T.StructType, T.ArrayType, T.MapType)
FILE_KEY = ["path", "modificationTime", "length"]
LEDGER_SCHEMA = "path string, modificationTime timestamp, length long, batch long"
FOOTERS_AT_ONCE = 16
SMALL_FILE = 32 << 20  # files up to this size are read whole by a task for their footer
TAIL = 1 << 16
OVERLAP = timedelta(days=2)
FULL_EVERY = 7
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
RAW_SCHEMA = "record variant, source_file string, loaded_at timestamp_ntz"


def nested_to_json(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text; all others untouched."""
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, NESTED)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def overwrite_partitions(df: DataFrame, path: str, *keys: str, rebalance: bool = True) -> None:
    """Replace only the partitions that occur in ``df``.

    Rebalancing gathers a partition's rows into few files; AQE splits one that
    holds much more than the others over several tasks.
    """
    spread = df.hint("rebalance", *keys) if rebalance else df
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def write_raw(df: DataFrame, path: str, upper: str, expected: int, run_date: str | None = None) -> str | None:
    """Land one run under its UTC date and the change time it reaches.

    A retry of the same window replaces its folder. A second window on the same
    day gets its own folder and cannot erase the first.
    """
    if not expected:
        return None
    run_date = run_date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
    stamped = nested_to_json(df).withColumns({"dt": F.lit(run_date), "upper": F.lit(upper)})
    land(stamped, expected, path, "dt", "upper", rebalance=False)
    return f"{path}/dt={run_date}"


def ingest(source: DataFrame, ts: str, raw_path: str, bookmark: Bookmark, type_filter=None,
           default: str = "1970-01-01", run_date: str | None = None) -> dict:
    """One incremental run: read the bookmark, extract, write, and only then move the bookmark.

    A crash before the last step repeats the window; it never skips one.
    """
    old = bookmark.get(default)
    extract = extract_since(source, ts, old, type_filter)
    if extract.expected == 0:
        return {"rows": 0, "watermark": old}
    upper = extract.upper
    folder = upper.replace(" ", "T").replace(":", "")
    file = write_raw(extract.rows, raw_path, folder, extract.expected, run_date)
    bookmark.set(upper)
    return {"rows": extract.expected, "file": file, "old": old, "new": upper}


def backfill(source: DataFrame, created: str, raw_path: str, start: str, end: str) -> DataFrame:
    """Rows created in [start, end), one partition per month, whatever the bookmark says.

    All months are written by one job. Returns the stored rows of every month of the
    window, 0 for those without any; a month that came out empty loses its old folder.
    """
    spark = source.sparkSession
    window = between_half_open(
        source, created, F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    )
    by_month = nested_to_json(window).withColumn("created_month", month_label(created))
    land(by_month, window.count(), raw_path, "created_month")
    last = (date.fromisoformat(end) - timedelta(days=1)).isoformat()
    months = month_windows(spark, start[:7], last).select(F.col("label").alias("created_month"))
    wanted = [r[0] for r in months.collect()]  # a window's months, a dozen a year
    here = [m for m in wanted if f"created_month={m}" in set(folders(spark, raw_path))]
    stored = read_or_empty(spark, raw_path, "created_month string").filter(F.col("created_month").isin(*here))
    return months.join(counts_by(stored, ["created_month"]), ["created_month"], "left").fillna(0, subset=["n"])


def load_years(source: DataFrame, raw_path: str, years: list[str] | None = None) -> DataFrame:
    """Full load of some (default: all) report years; each replaces its own partition.

    The folder key is a copy, so that the files still hold the report year. Returns the
    stored rows of the loaded years.
    """
    chosen = source.filter(F.col("report_year").isin(*years)) if years else source
    expected = chosen.count()
    land(nested_to_json(chosen).withColumn("year", F.col("report_year")), expected, raw_path, "year")
    stored = read_or_empty(source.sparkSession, raw_path, "report_year string, year string")
    loaded = stored.filter(F.col("year").isin(*years)) if years else stored
    return counts_by(loaded, ["report_year"])


def scan_with_lineage(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet rows with the file they came from."""
    return spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias("source_file"))


def base_name(path: str):
    return F.element_at(F.split(path, "/"), -1)


def rows_per_file(df: DataFrame, file: str = "source_file", loaded: str = "loaded_at") -> DataFrame:
    return df.groupBy(file).agg(F.count(F.lit(1)).alias("n"), F.max(loaded).alias(loaded))


def footer_bytes(content: Column) -> Column:
    """The footer of a Parquet file's bytes, with the length and the magic word that end it."""
    size = F.hex(F.substring(content, -8, 4))  # the least byte first
    digits = F.concat(*[F.substring(size, at, 2) for at in (7, 5, 3, 1)])
    n = F.conv(digits, 16, 10).cast("int") + 8
    return F.substring(content, -n, n)


def schema_mark(footer: bytes) -> str:
    """Equal for files that Spark reads with the same schema."""
    meta = pq.read_metadata(pa.BufferReader(b"PAR1" + footer))
    columns = str(meta.schema).partition("\n")[2]  # the first line names an object
    spark_schema = (meta.metadata or {}).get(SPARK_SCHEMA, b"")
    return sha256(columns.encode() + b"\n" + spark_schema).hexdigest()


class RawTable:
    """Append-only table of VARIANT records, loaded from files exactly once per file version.

    A file counts as loaded by path, modification time and length, so a file
    that was overwritten in place is loaded again. Rows go to the partition of
    the batch number; the ledger is written after them, and a batch without a
    ledger entry is replaced by the next run, which has the same number.

    A load asks the stage for files changed since the newest one that the load before has
    seen, less ``overlap``, and compares these with the ledger entries of that time. A
    file that appears later under an older time (one that was moved there) is found by
    the next full listing: each stage's first load makes one, then every ``full_every``-th.
    """

    def __init__(
        self, spark: SparkSession, path: str, overlap: timedelta = OVERLAP, full_every: int = FULL_EVERY
    ):
        self.spark = spark
        self.rows_path = f"{path}/rows"
        self.ledger_path = f"{path}/ledger"
        self.listings_path = f"{path}/listings"
        self.overlap, self.full_every = overlap, full_every

    def listings(self, stage: str) -> Bookmark:
        """The newest change time that the loads of a stage have seen, in UTC."""
        name = sha256(stage.rstrip("/").encode()).hexdigest()[:16]
        return Bookmark(self.spark, f"{self.listings_path}/{name}")

    def ledger(self) -> DataFrame:
        return read_or_empty(self.spark, self.ledger_path, LEDGER_SCHEMA)

    def rows(self, after: int | None = None) -> DataFrame:
        """Rows of committed batches (only those ``after`` a batch, if given), with their batch.

        At most one batch beyond the committed ones can be unfinished. The batch is a
        partition column, so this is a partition filter and leaves the scan open to
        reading single fields of the records.
        """
        stored = read_or_empty(self.spark, self.rows_path, f"{RAW_SCHEMA}, batch long")
        newest = self.ledger().agg(F.max("batch").alias("newest"))
        committed = stored.filter(F.col("batch") <= newest.scalar())
        return committed if after is None else committed.filter(F.col("batch") > after)

    def new_files(self, stage: str, since: datetime | None = None) -> DataFrame:
        """Files of the stage that the ledger does not know, of those changed after ``since``
        (UTC) if given; only their metadata is read."""
        reader = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
        )
        known = self.ledger()
        if since is not None:
            reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
            known = known.filter(F.col("modificationTime") >= F.lit(since.replace(tzinfo=timezone.utc)))
        return reader.load(stage).select(*FILE_KEY).join(known, FILE_KEY, "left_anti")

    def last_batch(self) -> int:
        return self.ledger().agg(F.max("batch")).first()[0] or 0

    def load(
        self, stage: str, loaded_at: str | None = None, files_per_batch: int = 10_000, full: bool | None = None
    ) -> int:
        """Load new files; returns how many. Running it again without new files does nothing.

        ``loaded_at`` (default: now, UTC) stamps the rows; loads with equal stamps are
        told apart by their batch. Only file names pass the driver, a bounded number at
        a time. ``full`` lists the whole stage, whenever its files changed (default: at the
        stage's first load and then now and again).
        """
        loaded_at = loaded_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        batch, loaded = self.last_batch(), 0
        listings = self.listings(stage)
        seen, number = listings.get(), listings.next_batch()
        newest = datetime.fromisoformat(seen) if seen else None
        if full is None:
            full = newest is None or number % self.full_every == 0
        since = None if full or newest is None else newest - self.overlap
        listed = self.new_files(stage, since).select("*", F.unix_micros("modificationTime").alias("_at"))
        listed = listed.toLocalIterator()
        while files := [tuple(f) for f in islice(listed, files_per_batch)]:
            batch += 1
            self._load_batch([f[:-1] for f in files], loaded_at, batch)
            loaded += len(files)
            last = datetime.fromtimestamp(max(f[-1] for f in files) // 1_000_000, timezone.utc).replace(tzinfo=None)
            newest = max(newest or last, last)
        if newest is not None:
            listings.set(newest.isoformat())
        return loaded

    def _marks(self, files: list[tuple]) -> list[tuple[str, str]]:
        """Path and schema mark of each file. Tasks read small files, all by one job; of a large
        one the driver reads the end."""
        small = [path for path, _, length in files if length <= SMALL_FILE]
        large = [(path, length) for path, _, length in files if length > SMALL_FILE]

        def marks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                part["mark"] = [schema_mark(f) for f in part.pop("footer")]
                yield part

        found: list[tuple[str, str]] = []
        if small:
            read = self.spark.read.format("binaryFile").load(small)
            footers = read.select("path", footer_bytes(F.col("content")).alias("footer"))
            found = [tuple(r) for r in footers.mapInPandas(marks, "path string, mark string").collect()]

        def of_large(path: str, length: int) -> tuple[str, str]:
            end = tail(self.spark, path, length, TAIL)
            size = int.from_bytes(end[-8:-4], "little") + 8
            return path, schema_mark((end if size <= len(end) else tail(self.spark, path, length, size))[-size:])

        with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
            return found + list(pool.map(lambda f: of_large(*f), large))

    def _by_schema(self, files: list[tuple]) -> list[tuple[T.StructType, list[str]]]:
        """Paths of files that share a schema. Spark infers each schema once, from one of its files."""
        alike: dict[str, list[str]] = {}
        for path, mark in sorted(self._marks(files)):
            alike.setdefault(mark, []).append(path)
        return [(self.spark.read.parquet(paths[0]).schema, paths) for paths in alike.values()]

    def _records(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        """A record holds the columns of its own file, in the file's own types."""
        read = self.spark.read.schema(schema).parquet(*paths)
        # a column without any value has no type of its own
        payload = F.struct(
            *[
                (F.col(f"`{f.name}`").cast("string") if f.dataType == T.NullType() else F.col(f"`{f.name}`")).alias(f.name)
                for f in schema.fields
            ]
        )
        return read.select(
            F.to_variant_object(payload).alias("record"), F.col("_metadata.file_path").alias("source_file")
        )

    def _load_batch(self, files: list[tuple], loaded_at: str, batch: int) -> None:
        parts = [self._records(schema, paths) for schema, paths in self._by_schema(files)]
        rows = reduce(DataFrame.unionAll, parts).withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
        # to the batch's own folder: a write by a partition column would sort the rows of each task
        rows.write.mode("overwrite").parquet(f"{self.rows_path}/batch={batch}")
        entries = self.spark.createDataFrame([(*f, batch) for f in files], LEDGER_SCHEMA)
        entries.coalesce(1).write.mode("append").parquet(self.ledger_path)
