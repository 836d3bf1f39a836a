"""Folders of any store that Spark reads."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    path: str
    name: str
    folder: bool
    changed: int


def _store(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies directly in a folder, by name; nothing below is listed.  Empty if there is no such folder."""
    store, hadoop = _store(spark, path)
    if not store.exists(hadoop):
        return []
    found = (Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getModificationTime()) for s in store.listStatus(hadoop))
    return sorted(found, key=lambda e: e.name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a file or folder if it is there."""
    store, hadoop = _store(spark, path)
    if store.exists(hadoop):
        store.delete(hadoop, True)


def stamp(spark: SparkSession, path: str) -> str | None:
    """What tells whether a file or folder is still as it was written: files, bytes and when it was committed; ``None`` if it is not there.

    A job that writes a folder ends with a new ``_SUCCESS``; the store sums up files and bytes itself, so nothing is listed here.
    """
    store, hadoop = _store(spark, path)
    if not store.exists(hadoop):
        return None
    summary, status = store.getContentSummary(hadoop), store.getFileStatus(hadoop)
    if status.isDirectory():
        done = hadoop.suffix("/_SUCCESS")
        changed = store.getFileStatus(done).getModificationTime() if store.exists(done) else 0
    else:
        changed = status.getModificationTime()
    return f"{summary.getFileCount()}:{summary.getLength()}:{changed}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside and then renamed: whoever finds it finds all of it."""
    store, target = _store(spark, path)
    aside = target.suffix(".tmp")
    stream = store.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if store.exists(target):
        store.delete(target, False)
    if not store.rename(aside, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or ``None`` if it is not there."""
    store, hadoop = _store(spark, path)
    if not store.exists(hadoop):
        return None
    stream = store.open(hadoop)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def read_head(spark: SparkSession, path: str, size: int = 4096) -> bytes:
    """The first bytes of a file, those of its contents if its name tells that it is compressed."""
    store, hadoop = _store(spark, path)
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    codec = codecs.getCodec(hadoop)
    stream = store.open(hadoop)
    try:
        stream = codec.createInputStream(stream) if codec else stream
        bounded = spark.sparkContext._jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(bounded))
    finally:
        stream.close()
