"""Current state of a republished log: newest version per key, kept by micro-batches.

Late and corrected records always win by version, never by arrival, and are
never dropped, so there is no event-time watermark and no state to expire. The
state is a Parquet table of hash buckets; a batch rewrites the buckets it
touches under its own version, writes a manifest, and commits by creating an empty
marker file in the finished manifest. A manifest without the marker, whole, partial or
empty, counts for nothing: readers never see a half-written batch, and its retry writes
it anew. Buckets that neither of the two newest commits names are removed after each
commit, so that the store holds at most two versions of a key and a reader may be one
commit behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by
from ..sources.files import create, delete, exists, folders
from ..sources.raw import overwrite_partitions
from ..sources.state import read_or_empty

MANIFEST_SCHEMA = "state_bucket int, state_version long"
VERSIONS_KEPT = 2
MARKER = "_committed"


class LatestState:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        newest: Sequence[str],
        buckets: int = 256,
    ):
        self.spark, self.schema = spark, schema
        self.keys, self.newest, self.buckets = list(keys), list(newest), buckets
        self.table, self.manifests = f"{path}/table", f"{path}/manifests"

    def _numbers(self, path: str, prefix: str) -> list[int]:
        names = folders(self.spark, path)
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def _manifest_path(self, batch: int) -> str:
        return f"{self.manifests}/batch={batch}"

    def _commits(self) -> list[int]:
        """Committed batches whose manifests are still there; a few."""
        written = self._numbers(self.manifests, "batch=")
        return [b for b in written if exists(self.spark, f"{self._manifest_path(b)}/{MARKER}")]

    def _manifest(self, batch: int | None = None) -> DataFrame:
        """Version of each bucket as of a commit (default: the newest); at most ``buckets`` rows."""
        commits = self._commits() if batch is None else [batch]
        if not commits:
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)
        return self.spark.read.schema(MANIFEST_SCHEMA).parquet(self._manifest_path(commits[-1]))

    def last_batch(self) -> int:
        return max(self._commits(), default=-1)

    def _stored(self, manifest: DataFrame) -> DataFrame:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        stored = read_or_empty(self.spark, self.table, f"{columns}, state_version long, state_bucket int")
        # both are partition columns: the scan is pruned to the current files
        return stored.join(manifest, ["state_version", "state_bucket"], "left_semi")

    def current(self) -> DataFrame:
        return self._stored(self._manifest()).drop("state_version", "state_bucket")

    def changed(self, since: int) -> tuple[DataFrame, DataFrame] | None:
        """Rows before and after, of the buckets rewritten since a commit; None if that commit is no longer kept.

        Only the files of these buckets are listed and read. A commit of -1 is the empty state.
        """
        commits = self._commits()
        if since != -1 and since not in commits:
            return None
        named = lambda batch: {r[0]: r[1] for r in self._manifest(batch).collect()}  # noqa: E731  a row per bucket
        old, new = (named(b) if b != -1 else {} for b in (since, commits[-1] if commits else -1))
        touched = [b for b in sorted(new) if new[b] != old.get(b)]
        paths = lambda kept: [f"{self.table}/state_version={kept[b]}/state_bucket={b}" for b in touched if b in kept]
        return self._files(paths(old)), self._files(paths(new))

    def _files(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def beside(self, rows: DataFrame) -> DataFrame:
        """Current rows of the buckets that the keys of ``rows`` fall into."""
        touched = rows.select(self._bucket().alias("state_bucket")).distinct()
        found = self._stored(self._manifest().join(touched, "state_bucket", "left_semi"))
        return found.drop("state_version", "state_bucket")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch. A batch that was already committed is skipped."""
        if batch_id <= self.last_batch():
            return
        incoming = batch.select(*self.schema.fieldNames()).withColumn("state_bucket", self._bucket())
        incoming = incoming.persist(StorageLevel.MEMORY_AND_DISK)  # read three times below
        try:
            manifest = self._manifest()
            touched = incoming.select("state_bucket").distinct()
            old = self._stored(manifest.join(touched, "state_bucket", "left_semi")).drop("state_version")
            merged = latest_by(old.unionByName(incoming), self.keys, self.newest)
            versioned = merged.withColumn("state_version", F.lit(batch_id).cast("long"))
            overwrite_partitions(versioned, self.table, "state_version", "state_bucket")
            self._commit(manifest, touched, batch_id)
        finally:
            incoming.unpersist()

    def _commit(self, manifest: DataFrame, touched: DataFrame, batch_id: int) -> None:
        kept = manifest.join(touched, "state_bucket", "left_anti").select("state_bucket", "state_version")
        moved = touched.select("state_bucket", F.lit(batch_id).cast("long").alias("state_version"))
        path = self._manifest_path(batch_id)
        kept.unionByName(moved).coalesce(1).write.mode("overwrite").parquet(path)
        create(self.spark, f"{path}/{MARKER}")
        self._drop_superseded()

    def _drop_superseded(self) -> None:
        """Remove what no commit of the newest two names.

        That is: buckets that older commits name, the manifests of these and of abandoned
        batches, and whole versions that an abandoned batch has left. A manifest goes after
        its buckets, so that a crash in between is made good next time.
        """
        commits = self._commits()
        named = lambda batch: {tuple(r) for r in self._manifest(batch).collect()}  # noqa: E731  a row per bucket
        kept = set().union(*map(named, commits[-VERSIONS_KEPT:]))
        versions = {version for _, version in kept}
        for version in self._numbers(self.table, "state_version="):
            if version < commits[-1] and version not in versions:
                delete(self.spark, f"{self.table}/state_version={version}")
        for batch in commits[:-VERSIONS_KEPT]:
            for bucket, version in named(batch) - kept:
                delete(self.spark, f"{self.table}/state_version={version}/state_bucket={bucket}")
            delete(self.spark, self._manifest_path(batch))
        for batch in self._numbers(self.manifests, "batch="):
            if batch < commits[-1] and batch not in commits:
                delete(self.spark, self._manifest_path(batch))

    def follow(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Process all files available now; re-delivered batches change nothing."""
        return (
            stream.writeStream.foreachBatch(lambda df, batch_id: self.upsert(df, batch_id))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
