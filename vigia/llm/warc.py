"""Web archives: writing WARC records, and reading them back by boundary-chain verification.

Writing: one record per row through Spark's text writer, whose line separator supplies the last two bytes of each record.  Of
equal payloads the one with the smallest id is written in full, the others as revisits of it.

Reading: archives are read in splits, at every place where a record might begin.  A task cannot tell a record from its magic
inside a payload, so it takes each such place for a candidate and works out where the record that begins there would end:
its successor.  The candidates of a file form chains; pointer jumping from the start of the file, with jumps that double in each
round, keeps those that are reached.  Payloads that hold the magic are put together again.  Candidates carry offsets
and digests through the rounds, never payloads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigia.llm.common import stored
from vigia.sources.scratch import scratch_path

#: Payloads from this many bytes on can be revisits.
LEAST_BYTES = 100
#: A record begins at the start of a file or after a line feed.
MAGIC = "\nWARC/1."
#: Fixed value: the only time stamp of written records, so that archives of equal rows are equal.
DATE = "2024-01-01T00:00:00Z"

_MAGIC, _GAP = MAGIC.encode(), b"\r\n\r\n"


# --- Writing ------------------------------------------------------------------------------------------------------------


def describe(df: DataFrame, id: str, url: str | None, html: str) -> DataFrame:
    """(id, url, payload, bytes, digest): payloads as text, their UTF-8 length and SHA-256."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    # A line break would end the header line.
    address = F.coalesce(F.regexp_replace(F.col(url).cast("string"), "[\\x00-\\x20\\x7f]", "%20"), F.lit("")) if url else F.lit("")
    return df.select(F.col(id).cast("bigint").alias("id"), address.alias("url"), payload.alias("payload"),
                     F.octet_length(payload).cast("bigint").alias("bytes"), F.sha2(payload.cast("binary"), 256).alias("digest"))


def first_copies(described: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(digest, first): the smallest id of each payload of ``least`` bytes or more that several rows have."""
    large = described.where((F.col("bytes") >= least) & F.col("id").isNotNull())
    copies = large.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    return stored(copies.where("n > 1").select("digest", "first"), "warc-copies")


def record(revisit: Column, first: Column) -> Column:
    """A record without its last two bytes, which are the line separator of the file."""
    crlf = "\r\n"
    number = F.coalesce(F.col("id").cast("string"), F.lit("none"))
    head = F.concat(
        F.lit(f"WARC/1.1{crlf}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{crlf}WARC-Record-ID: <urn:page:"), number, F.lit(f">{crlf}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{crlf}WARC-Date: {DATE}{crlf}WARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit(f"{crlf}Payload-Length: "), F.col("bytes").cast("string"),
        F.when(revisit, F.concat(
            F.lit(f"{crlf}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{crlf}WARC-Refers-To: <urn:page:"),
            first.cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{crlf}Content-Length: "), F.when(revisit, "0").otherwise(F.col("bytes").cast("string")), F.lit(crlf + crlf))
    return F.concat(head, F.when(revisit, "").otherwise(F.col("payload")), F.lit(crlf))


def write_archives(df: DataFrame, path: str, *, id: str = "page_id", url: str | None = "url", html: str = "html",
                   least: int = LEAST_BYTES) -> None:
    """Writes a record for every row of ``df`` to WARC files below ``path``.

    A NULL payload counts as empty.  Rows whose id repeats are each written; rows with a NULL id are never revisits and never
    revisited.  An empty table writes no record.  Other columns are not looked at.
    """
    rows = describe(df, id, url, html)
    copies = first_copies(rows, least)
    # Only payloads that repeat are in the table: it is small unless the corpus is full of copies, and then a
    # shuffle join whose hot digests Spark can split.
    joined = rows.join(copies, "digest", "left")
    revisit = F.col("first").isNotNull() & F.col("id").isNotNull() & (F.col("id") != F.col("first"))
    joined.select(record(F.coalesce(revisit, F.lit(False)), F.col("first")).alias("value")).write.option("lineSep", "\r\n").text(path)


# --- Reading ------------------------------------------------------------------------------------------------------------

#: What is known of a record from its header; its length and, if all of its bytes were at hand, its payload's SHA-256.
FIELDS = "id string, type string, uri string, refers string, said_bytes bigint, said_digest string, length bigint, digest string"
#: Offsets count from the first piece of the split; ``size`` is that of the split's pieces, in one row without ``start``.
CANDIDATE = f"file string, split bigint, start bigint, body bigint, next bigint, exit bigint, size bigint, {FIELDS}"


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, size, piece) of all archives: what stands between two magics, in file order within a split, and the file's size."""
    rows = spark.read.option("lineSep", MAGIC).option("recursiveFileLookup", "true").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                       F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list[bytes]]]:
    """File, split, file size and pieces of each split; a task holds one split at a time."""
    key, held = None, []
    for batch in batches:
        for *at, piece in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if at != key:
                if key:
                    yield *key, held
                key, held = at, []
            held.append(piece)
    if key:
        yield *key, held


def _header(piece: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields of the record that ``piece`` begins, without its magic, and the header's length; None if there is no header.

    No header holds the magic, but the magic may follow at once: then the header's last line feed is part of it.
    """
    end = (piece + b"\n").find(_GAP)
    if end < 0:
        return None
    fields: dict[str, str] = {}
    for line in piece[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def _candidates(file: str, split: int, pieces: list[bytes]) -> list[tuple]:
    """Rows of ``CANDIDATE`` for one split."""
    places, at = [], 0
    for piece in pieces:
        places.append(at)
        at += len(piece) + len(_MAGIC)
    found: dict[int, tuple[int, int, int, dict[str, str]]] = {}
    for k, piece in enumerate(pieces):
        start = places[k] - len(_MAGIC) + 1
        if split == 0 and k == 0:
            # The file's first record has no line feed before it.
            if not piece.startswith(_MAGIC[1:]):
                continue
            start, piece = 0, piece[len(_MAGIC) - 1:]
        header = _header(piece)
        if header:
            body = start + len(_MAGIC) - 1 + header[1]
            found[start] = k, body, body + int(header[0]["content-length"]) + 4, header[0]
    rows, exits = [], {}
    for start in sorted(found, reverse=True):
        k, body, following, fields = found[start]
        exits[start] = exits.get(following, following)
        # A record is followed by another, by the end of the file or by what lies beyond this split.
        if following not in found and following < at - len(_MAGIC):
            continue
        length = following - 4 - body
        digest = None
        if body + length <= at - len(_MAGIC):
            digest = hashlib.sha256(_between(pieces, places, k, body, body + length)).hexdigest()
        said = fields.get("payload-length", "")
        rows.append((file, split, start, body, following, exits[start], None, fields.get("warc-record-id"), fields.get("warc-type"),
                     fields.get("warc-target-uri"), fields.get("warc-refers-to"), int(said) if said.isdigit() else None,
                     fields.get("warc-payload-digest"), length, digest))
    rows.append((file, split, None, None, None, None, at, *[None] * 8))
    return rows


def _between(pieces: list[bytes], places: list[int], k: int, first: int, last: int) -> bytes:
    """The bytes from ``first`` to ``last``, which begin in piece ``k`` or later."""
    out = []
    while k < len(pieces) and places[k] < last:
        whole = pieces[k] + _MAGIC
        out.append(whole[max(0, first - places[k]):max(0, last - places[k])])
        k += 1
    return b"".join(out)


def _arrow(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=kinds[f.dataType]) for c, f in zip(columns, schema, strict=True)], names=schema.names)


def candidates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``CANDIDATE`` with offsets in their file, and (file, split, first): the offset of each split's first piece.

    A split's pieces are whole, also the last, which reaches into the next split: the sizes before a split add up to its offset.
    """
    schema = T._parse_datatype_string(CANDIDATE)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, split, _, pieces in _runs(batches):
            yield _arrow(_candidates(file, split, pieces), schema)

    found = stored(_pieces(spark, path).mapInArrow(emit, schema), "warc-candidates")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored(found.where("start IS NULL").select(
        "file", "split", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first")), "warc-splits")
    moved = found.where("start IS NOT NULL").join(firsts, ["file", "split"])
    offsets = [(F.col(c) + F.col("first")).alias(c) for c in ("start", "body", "next", "exit")]
    kept = [c for c in schema.names if c not in ("start", "body", "next", "exit", "size")]
    return moved.select(*kept, *offsets), firsts


def reachable(links: DataFrame) -> DataFrame:
    """(file, start) of the places that are reached from the start of their file, given (file, start, next).

    Pointer jumping: each round adds what the reached places jump to, and then doubles all jumps, so that the number of
    rounds is the logarithm of the longest chain.
    """
    reached = stored(links.where("start = 0").select("file", "start").distinct(), "warc-reached")
    jumps, size = stored(links, "warc-jumps"), reached.count()
    while True:
        landed = reached.join(jumps, ["file", "start"]).select("file", F.col("next").alias("start"))
        after = stored(reached.unionByName(landed).distinct(), "warc-reached")
        count = after.count()
        if count == size:
            return after
        hop = jumps.select("file", F.col("start").alias("next"), F.col("next").alias("far"))
        jumps = stored(jumps.join(hop, ["file", "next"]).select("file", "start", F.col("far").alias("next")), "warc-jumps")
        reached, size = after, count


def _walked(frame: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one split that the chain from the split's entry meets."""
    place = {start: k for k, start in enumerate(frame["start"])}
    keep = np.zeros(len(frame), dtype=bool)
    for k in np.flatnonzero(frame["entry"].to_numpy()):
        while k is not None and not keep[k]:
            keep[k] = True
            k = place.get(frame["next"].iat[k])
    return frame.loc[keep].drop(columns="entry")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, ``FIELDS``): the records of all WARC files below ``path``.

    Magic inside a payload starts no record.  A file that does not begin with a record has none; at a record whose successor is no
    record the chain of its file ends.  ``digest`` is the SHA-256 of the payload as read, NULL if the file ends within it.  Files are
    uncompressed; an empty folder or file gives no rows.
    """
    found, firsts = candidates(spark, path)
    found = stored(found, "warc-placed")
    # Each task has followed its own part of the chains: only from split to split are jumps left.
    entries = reachable(found.select("file", "start", F.col("exit").alias("next")))
    marked = found.join(entries.withColumn("entry", F.lit(True)), ["file", "start"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    names = [c for c in marked.columns if c != "entry"]
    walked = marked.groupBy("file", "split").applyInPandas(_walked, T.StructType([marked.schema[c] for c in names]))
    records = stored(walked, "warc-records")
    columns = ["file", "start", *T._parse_datatype_string(FIELDS).names]
    cut = records.where("digest IS NULL AND length > 0").select("file", "start", "body", "length")
    empty = F.when(F.col("length") == 0, F.lit(hashlib.sha256(b"").hexdigest()))
    if cut.isEmpty():
        return records.withColumn("digest", F.coalesce("digest", empty)).select(*columns)
    whole = joined_payloads(spark, path, cut, firsts).withColumnRenamed("digest", "joined")
    return records.join(whole, ["file", "start"], "left").withColumn("digest", F.coalesce("digest", empty, "joined")).select(*columns)


def joined_payloads(spark: SparkSession, path: str, cut: DataFrame, firsts: DataFrame, at_once: int = 10_000) -> DataFrame:
    """(file, start, digest) of the records ``cut`` (file, start, body, length), whose payload reaches into another split.

    That takes magic inside the payload and a split between: few records, whose offsets are sent to the tasks ``at_once`` at a time.
    """
    parts, out = max(1, -(-cut.count() // (at_once // 2))), None
    schema = T._parse_datatype_string("file string, start bigint, length bigint, place bigint, data binary")
    for part in range(parts):
        some = cut.where(F.pmod(F.xxhash64("file", "start"), F.lit(parts)) == part).collect()
        wanted: dict[str, list[tuple[int, int, int]]] = {}
        for row in some:
            wanted.setdefault(row["file"], []).append((row["start"], row["body"], row["body"] + row["length"]))
        shifts = {(r["file"], r["split"]): r["first"] for r in firsts.where(F.col("file").isin(list(wanted))).collect()}
        known = spark.sparkContext.broadcast((wanted, shifts))

        def emit(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            wanted, shifts = known.value
            for file, split, size, pieces in _runs(batches):
                place, rows = shifts.get((file, split), 0), []
                for piece in pieces:
                    # No magic follows the last piece of a file.
                    whole = (piece + _MAGIC)[:max(0, size - place)]
                    for start, first, last in wanted.get(file, ()):
                        if first < place + len(whole) and place < last:
                            rows.append((file, start, last - first, place, whole[max(0, first - place):last - place]))
                    place += len(whole)
                if rows:
                    yield _arrow(rows, schema)

        def join(table: pa.Table) -> pa.Table:
            table = table.sort_by("place")
            data = b"".join(table.column("data").to_pylist())
            length = table.column("length")[0].as_py()
            digest = hashlib.sha256(data).hexdigest() if len(data) == length else None
            return pa.table({"file": [table.column("file")[0].as_py()], "start": pa.array([table.column("start")[0].as_py()], pa.int64()),
                             "digest": pa.array([digest], pa.string())})

        made = _pieces(spark, path).mapInArrow(emit, schema).groupBy("file", "start").applyInArrow(join, "file string, start bigint, digest string")
        out = made if out is None else out.unionByName(made)
    return out


def round_trip(df: DataFrame, *, id: str = "page_id", url: str | None = "url", html: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Writes the archives of ``df`` to the shared scratch folder and reads them back (``read_archives``)."""
    path = scratch_path(df.sparkSession, "warc")
    write_archives(df, path, id=id, url=url, html=html, least=least)
    return read_archives(df.sparkSession, path)
