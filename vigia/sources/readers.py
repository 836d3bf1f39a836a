"""Scans of raw snapshots, zone datasets and relational tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigia.sources.files import entries, read_head


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON files that hold an array (or one object) each.

    Such a file cannot be split, so it is one task; land large lists as many page files or as JSON
    lines.  With a schema there is no inference pass.
    """
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines, the splittable form."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_csv(spark: SparkSession, path: str | list[str], infer: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header.

    Columns are strings unless ``infer`` (a second pass over the file) or a schema (columns in file
    order) is asked for.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_cases(spark: SparkSession, root: str, first: tuple[int, int] | None = None,
               last: tuple[int, int] | None = None) -> DataFrame:
    """Trusted cases; a (year, month) range becomes partition filters."""
    df = spark.read.parquet(root)
    year, month = F.col("anio_reporte"), F.col("mes_reporte")
    if first:
        df = df.filter((year > first[0]) | ((year == first[0]) & (month >= first[1])))
    if last:
        df = df.filter((year < last[0]) | ((year == last[0]) & (month <= last[1])))
    return df


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """The newest snapshot directly in a folder.

    Snapshot folders are named ``snapshot=<time>``: the largest time that has been written to its end
    (``_SUCCESS``) is taken, whenever it was written.  Without such folders it is the newest loose file, by
    modification time and then path.
    """
    found = entries(spark, root)
    stamped = [e for e in found if e.folder and e.name.startswith("snapshot=")]
    for entry in sorted(stamped, key=lambda e: e.name, reverse=True):
        if any(e.name == "_SUCCESS" for e in entries(spark, entry.path)):
            return entry.path
    loose = [e for e in found if not e.folder and e.name[0] not in "._"]
    if not loose:
        raise FileNotFoundError(f"no snapshot in {root}")
    return max(loose, key=lambda e: (e.changed, e.path)).path


def typed_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema, found by name; a column that is not there is NULL, a value that does not fit too."""
    known = {c.lower(): c for c in df.columns}
    return df.select(*(
        (F.col(f"`{known[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in known else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields))


def read_latest(spark: SparkSession, root: str, schema: T.StructType | None = None, csv_as_strings: bool = False) -> DataFrame:
    """Read the newest snapshot in a folder, all of its files, in the format their names tell.

    A JSON file whose first line is an object by itself is JSON lines, any other is an array or object; a snapshot may hold both, and a
    record that cannot be read is an error.  CSV columns are matched with the schema by header and inferred without one
    (``csv_as_strings``: all strings, as they stand).  A snapshot without data is an empty table.
    """
    path = latest_snapshot(spark, root)
    inside = [e.path for e in entries(spark, path) if not e.folder and e.name[0] not in "._"]
    if not inside:
        if schema is None:
            raise ValueError(f"{path} is empty and no schema is given")
        return spark.createDataFrame([], schema)
    kinds = {re.search(r"[.](json|csv)([.]\w+)?$", p).group(1) if re.search(r"[.](json|csv)([.]\w+)?$", p) else None for p in inside}
    if kinds == {"csv"}:
        rows = read_csv(spark, inside, infer=schema is None and not csv_as_strings)
        return rows if schema is None or csv_as_strings else typed_by_name(rows, schema)
    if kinds != {"json"}:
        raise ValueError(f"no reader for {path}")
    lines = {path: _is_object(_first_line(spark, path)) for path in inside}
    parts = []
    for as_lines in (True, False):
        paths = [path for path in inside if lines[path] == as_lines]
        if paths:
            reader = spark.read.option("mode", "FAILFAST").option("multiLine", not as_lines)
            parts.append((reader.schema(schema) if schema else reader).json(paths))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file that is not blank, from its first bytes, in which a record's line need not end."""
    head = read_head(spark, path).decode("utf-8", "ignore").lstrip("\ufeff \t\r\n")
    first, end, _ = head.partition("\n")
    if not head or end:
        return first or "{}"
    # A line longer than the head: as long as a record can be told by, in full.
    first = spark.read.text(path).where(F.trim("value") != "").first()
    return first[0] if first else "{}"


def _is_object(line: str) -> bool:
    try:
        return isinstance(json.loads(line.lstrip("\ufeff")), dict)
    except ValueError:
        return False


def unfitting_values(spark: SparkSession, root: str, schema: T.StructType) -> dict[str, int]:
    """How many values of the newest snapshot's CSV files are not of the type that ``schema`` asks for, by column; those are NULL when read.

    Columns without any are left out.  JSON is read strictly and has none.
    """
    path = latest_snapshot(spark, root)
    inside = [e.path for e in entries(spark, path) if not e.folder and re.search(r"[.]csv([.]\w+)?$", e.path)]
    if not inside:
        return {}
    rows = read_csv(spark, inside)
    known = {c.lower(): c for c in rows.columns}
    checks = [F.count(F.when(F.col(f"`{known[f.name.lower()]}`").isNotNull() & F.col(f"`{known[f.name.lower()]}`").try_cast(f.dataType).isNull(), 1)).alias(f.name)
              for f in schema.fields if f.name.lower() in known]
    if not checks:
        return {}
    return {name: n for name, n in rows.agg(*checks).first().asDict().items() if n}


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A whole relational table over JDBC, in parallel ranges of a numeric column if one is given."""
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        raise ValueError("a partition column needs bounds")
    return spark.read.jdbc(
        url, table, column=column, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=properties,
    )
