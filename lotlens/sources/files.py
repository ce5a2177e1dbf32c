"""Folders of the stores that Spark reaches: delete, list and move."""

from __future__ import annotations

from pyspark.sql import SparkSession

ASIDE = "_replaced-"  # Spark does not read names with a leading underscore


def _at(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if it is not there."""
    store, at = _at(spark, path)
    store.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted."""
    store, at = _at(spark, path)
    if not store.exists(at):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(at) if f.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _at(spark, path)
    return store.exists(at)


def create(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    store, at = _at(spark, path)
    store.create(at, True).close()


def _move(spark: SparkSession, source: str, target: str) -> None:
    store, new = _at(spark, target)
    if not store.rename(_at(spark, source)[1], new):
        raise OSError(f"cannot move {source} to {target}")


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder to ``target``, in place of what is there.

    What is there goes aside under a hidden name first and comes back if the move fails.
    If the process dies between the two moves, ``restore`` brings it back.
    """
    store, new = _at(spark, target)
    aside = f"{target.rpartition('/')[0]}/{ASIDE}{new.getName()}"
    restore(spark, target)
    store.mkdirs(new.getParent())
    if held := store.exists(new):
        _move(spark, target, aside)
    try:
        _move(spark, source, target)
    except BaseException:
        if held:
            _move(spark, aside, target)
        raise
    delete(spark, aside)


def restore(spark: SparkSession, target: str) -> None:
    """Undo or finish a ``replace`` of ``target`` that died halfway; the old one comes back if the new is not there."""
    aside = f"{target.rpartition('/')[0]}/{ASIDE}{target.rpartition('/')[2]}"
    if exists(spark, aside):
        if exists(spark, target):
            delete(spark, aside)
        else:
            _move(spark, aside, target)


def tail(spark: SparkSession, path: str, length: int, n: int) -> bytes:
    """The last ``n`` bytes of a file of ``length`` bytes."""
    store, at = _at(spark, path)
    stream = store.open(at)
    try:
        stream.seek(max(0, length - n))
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[tuple]:
    """Path, change time and length of all files below ``path``, sorted."""
    store, at = _at(spark, path)
    files, found = store.listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getModificationTime(), f.getLen()))
    return sorted(found)
