"""Writes to the zones."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from vigia.sources.files import entries, remove_path


def write_parquet(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """Overwrite a parquet folder; returns its rows.

    The rows are counted from the footers of the written files.  That reads no data, and unlike a
    counter kept while writing it stays right when tasks run again after an executor is lost.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


#: Order of the rows of a file of cases, and columns with a Bloom filter in each row group.
WITHIN = ("codigo_departamento", "id_caso")
BLOOM = ("id_caso",)


def deal(df: DataFrame, by: Sequence[str], derived: Mapping[str, Column]) -> DataFrame:
    """The rows brought together by the columns of ``by``, then the other ``derived`` columns added."""
    keyed = df.withColumns({c: derived[c] for c in by if c in derived})
    return keyed.hint("rebalance", *by).withColumns({c: e for c, e in derived.items() if c not in by})


def write_cases(df: DataFrame, root: str, by: Sequence[str] = ("anio_reporte", "mes_reporte"),
                replace_only_present: bool = False, options: Mapping[str, str] | None = None,
                derived: Mapping[str, Column] | None = None) -> int:
    """Parquet partitioned by report year and month; returns the rows of the whole dataset.

    REBALANCE brings the rows of a month together, so that a month does not end in one small file
    per task, and adaptive execution cuts a month that is far larger than the others into several
    files.  ``replace_only_present`` keeps the partitions the new data does not touch.

    Within a file rows are in the order of their department and id.  The statistics of its row groups then tell which of them
    hold a department at all, and their Bloom filters tell the same of an id: a reader skips the others.

    ``derived`` columns follow from the others of their row.  All but those of ``by`` are added once the rows are dealt, so that
    they do not cross the network.
    """
    dealt = deal(df, by, derived or {})
    rows = dealt.sortWithinPartitions(*by, *[c for c in WITHIN if c in dealt.columns])
    writer = rows.write.mode("overwrite").options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM if c in rows.columns})
    mode = "dynamic" if replace_only_present else "static"
    writer.options(**(options or {})).option("partitionOverwriteMode", mode).partitionBy(*by).parquet(root)
    return df.sparkSession.read.schema(rows.schema).parquet(root).count()


def flat_columns(df: DataFrame) -> list[str]:
    """Columns a CSV file can hold: no vector, array, map or struct."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType, T.BinaryType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; blanks around values are kept (Spark's writer trims them by default)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def save_result(df: DataFrame, folder: str, name: str, one_file: bool = True) -> int:
    """``<name>.parquet`` and, read back from it, ``<name>.csv``; returns the rows.

    The plan runs once.  The CSV copy is one file for datasets that code lists bound (``one_file``, declared
    with the dataset and never decided by a count); any other is copied by as many tasks as it has files.
    """
    target = f"{folder.rstrip('/')}/{name}"
    rows = write_parquet(df, f"{target}.parquet")
    written = df.sparkSession.read.schema(df.schema).parquet(f"{target}.parquet")
    flat = written.select(*flat_columns(written))
    write_csv(flat.coalesce(1) if one_file else flat, f"{target}.csv")
    return rows


def save_if_any(spark: SparkSession, df: DataFrame | None, folder: str, name: str, one_file: bool = True) -> int | None:
    """Save a result unless it is absent or empty; ``None`` then, and what an earlier run left is removed.

    The test may run the plan again.
    """
    if df is None or df.isEmpty():
        remove_result(spark, folder, name)
        return None
    return save_result(df, folder, name, one_file)


def remove_result(spark: SparkSession, folder: str, name: str) -> None:
    """Removes a result that is no longer there, so that nothing stale is served."""
    for suffix in ("parquet", "csv"):
        remove_path(spark, f"{folder.rstrip('/')}/{name}.{suffix}")


def publish(df: DataFrame, table: str, path: str | None = None, keep: int = 2) -> str:
    """Replace the contents of a catalogue table at once; returns the folder of the new ones.

    The rows are written to a folder of their own, ``version=<time>-...`` below ``path`` (default: beside the session's
    warehouse tables), and then the table's location is set to it.  Until then readers have the old contents, and a load that
    fails leaves them; queries that run on go on reading the old folder, since the ``keep`` newest ones stay.
    A table whose columns have changed is declared anew.
    """
    spark = df.sparkSession
    if path is None:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '.db/')}_versions"
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    target = f"{path.rstrip('/')}/version={stamp}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.parquet(target)
    except Exception:
        remove_path(spark, target)
        raise
    location = target.replace("\\", "\\\\").replace("'", "\\'")
    columns = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    known = spark.catalog.tableExists(table)
    if known and spark.table(table).dtypes == columns:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        if known:
            spark.sql(f"DROP TABLE {table}")
        declared = ", ".join(f"`{name}` {kind}" for name, kind in columns)
        spark.sql(f"CREATE TABLE {table} ({declared}) USING parquet LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    versions = sorted((e for e in entries(spark, path) if e.folder and e.name.startswith("version=")), key=lambda e: e.name)
    for old in versions[:-keep]:
        remove_path(spark, old.path)
    return target
