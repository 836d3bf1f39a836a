"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from vigia.sources.files import remove_path
from vigia.sources.scratch import scratch_path

#: Texts are handed to numpy in slices of about this many characters, so that memory follows one
#: slice and not one Arrow batch; a longer single text is a slice of its own.
SLICE_CHARS = 4_000_000
#: Narrow rows that one file of ``gathered`` holds, about.
FILE_ROWS = 100_000

_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "array<float>": pa.list_(pa.float32()),
          "array<double>": pa.list_(pa.float64()),
          "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, folders: list[str] | None = None) -> DataFrame:
    """``df`` written below the shared scratch folder and read back: cuts the lineage, survives lost executors.

    The folder is noted in ``folders``, for whoever knows when its last reader is done.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    if folders is not None:
        folders.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, label: str, folders: list[str] | None = None) -> DataFrame:
    """As ``stored``, in as many files as the rows need and not one for each partition of a shuffle: for narrow rows.

    Each file that is made on a local file system starts a process for its permissions, and each costs a request elsewhere.
    The rows are computed in all partitions, wait on the executors' disks until they are counted, and are let go when written.
    """
    df = df.persist(StorageLevel.DISK_ONLY)
    try:
        return stored(df.coalesce(max(1, ceil(df.count() / FILE_ROWS))), label, folders)
    finally:
        df.unpersist()


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Removes scratch folders that nobody reads any more."""
    while folders:
        remove_path(spark, folders.pop())


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Spark hands at most so many rows at a time to Python: for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def slices(texts: Sequence[str | None]) -> Iterator[slice]:
    """Runs of texts of about ``SLICE_CHARS`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        more = len(text) if text else 0
        if i > start and size + more > SLICE_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += more
    if start < len(texts):
        yield slice(start, len(texts))


def annotate(df: DataFrame, text: str, make: Callable[[], Callable[[list[str | None]], dict[str, Sequence]]],
             fields: dict[str, str]) -> DataFrame:
    """``df`` with the columns ``fields`` (name: Spark type) computed from the column ``text``.

    ``make`` runs once in each task and gives a function from a list of texts to the new columns; if that has an
    attribute ``done``, it is called when the task has no more texts.
    A column of ``df`` that has the name of a new one is replaced.
    """
    new = {f.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in new]
    source = text if text in kept and df.schema[text].dataType == T.StringType() else free_name(df, "__text")
    extra = [] if source == text else [F.col(f"`{text}`").cast("string").alias(source)]
    rows = df.select(*(F.col(f"`{c}`") for c in kept), *extra)
    old = rows.schema.fields[:len(kept)]
    schema = T.StructType(old + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()])
    types = [_ARROW[t] for t in fields.values()]
    at = rows.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        try:
            for batch in batches:
                texts = batch.column(at).to_pylist()
                for part in slices(texts):
                    made = work(texts[part])
                    same = [c.slice(part.start, part.stop - part.start) for c in batch.columns[:len(kept)]]
                    yield pa.RecordBatch.from_arrays(
                        [*same, *(pa.array(made[n], type=t) for n, t in zip(fields, types, strict=True))], names=[*kept, *fields])
        finally:
            getattr(work, "done", lambda: None)()
            # The worker lives on: what Arrow keeps for later goes back.
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def held_out(key: str):
    """True for the third of the rows that no model may learn from; NULL ids count as held out nowhere."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def may_learn(key: str):
    return F.col(key).isNotNull() & ~held_out(key)


def codes(text: str) -> np.ndarray:
    """Code points; lone surrogates are kept."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
