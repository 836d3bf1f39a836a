"""Raw zone: snapshots and their audit."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A compressed file is read by one task, so none has more records.
FILE_RECORDS = 500_000


def land_snapshot(df: DataFrame, zone: str, dataset: str, at: datetime | None = None) -> str:
    """Write the rows as JSON lines below ``<zone>/<dataset>/snapshot=<time>``; returns that folder.

    Each line repeats the names of all fields, so the files are compressed, and cut by records, as a compressed file cannot be split.
    """
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    target = f"{zone.rstrip('/')}/{dataset}/snapshot={stamp}"
    writer = df.write.mode("errorifexists").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
    writer.json(target)
    return target


def land_tables(tables: Mapping[str, DataFrame], zone: str, prefix: str = "",
                at: datetime | None = None) -> DataFrame:
    """Land several tables; returns (dataset, registros) counted in the landed files."""
    spark = next(iter(tables.values())).sparkSession
    folders = {name: land_snapshot(df, zone, f"{prefix}{name}", at) for name, df in tables.items()}
    return audit({name: count_lines(spark, folder, header_lines=0) for name, folder in folders.items()})


def count_lines(spark: SparkSession, path: str, header_lines: int = 1) -> DataFrame:
    """(archivo, registros): lines of each file without its header, never below 0.

    Files are split like any text and counted per task first, so one huge file is no hot spot.
    """
    lines = (
        spark.read.text(path)
        .groupBy(F.col("_metadata.file_path").alias("archivo"))
        .agg(F.count(F.lit(1)).alias("lineas"))
    )
    return lines.select(
        "archivo",
        F.greatest(F.col("lineas") - F.lit(header_lines), F.lit(0)).cast("bigint").alias("registros"),
    )


def audit(counts: Mapping[str, DataFrame]) -> DataFrame:
    """One row (dataset, registros) for each table of counts."""
    rows = [
        df.agg(F.coalesce(F.sum("registros"), F.lit(0)).cast("bigint").alias("registros"))
        .select(F.lit(name).alias("dataset"), "registros")
        for name, df in counts.items()
    ]
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result
