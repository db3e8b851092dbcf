"""A quoted CSV log read by many tasks (S6): quote parity over byte ranges.

A quoted field may hold line breaks, so a reader that starts in the middle of a file does
not know whether it stands inside quotes; Spark's multi-line CSV reader therefore gives a
file to one task.  Doubled quotes count twice, so a line starts a record exactly when the
number of quotes before it in the file is even:

1. the text reader splits the file by byte ranges; every range counts its quotes (one row
   a range, combined before the shuffle);
2. a running sum over the ranges of a file gives each range the parity it starts with;
3. each task walks over the lines of its ranges and parses the records that begin and end there
   with Python's ``csv``; what a range's first or last record lacks is a *fragment*;
4. fragments (two a range at most) are put together by the record they belong to.

The lines themselves are never shuffled.  The ranges' parities are broadcast: one row
for every ``spark.sql.files.maxPartitionBytes``, up to ``BROADCAST_RANGES`` of them;
beyond that lines are dealt to their range and sorted instead.

Results equal the one-task reader's at any split size: records end at ``\\n`` or ``\\r\\n``,
blank lines are skipped, and a quote that is never closed is an error.  Fields that are
not quoted hold no quotes (RFC 4180).
"""

from __future__ import annotations

import csv

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.gates import header_gate
from ..operators.records import IMPORTED
from ..schemas import LOG_CSV_COLUMNS
from ..session import file_system, materialize

#: Rows of about 100 bytes; at the default split size this is 128 TB of CSV.
BROADCAST_RANGES = 1_000_000
#: Parsed records a batch.
RECORDS = 4096
_FIELDS = [("file", pa.string()), ("block", pa.int64()), ("rec", pa.int64()),
           *((c, pa.string()) for c in LOG_CSV_COLUMNS), ("header", pa.binary()), ("fragment", pa.binary())]
_SCHEMA = pa.schema(_FIELDS)
_SQL = ("file string, block long, rec long, " + ", ".join(f"{c} string" for c in LOG_CSV_COLUMNS)
        + ", header binary, fragment binary")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("n"), F.col("value"))


def ranges(lines: DataFrame) -> DataFrame:
    """(file, block, odd, header): whether a byte range starts inside quotes, and the
    file's first line."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"')))
    per = lines.groupBy("file", "block").agg(
        F.sum(quotes.cast("long")).alias("quotes"),
        F.min_by(F.when(F.col("block") == 0, F.col("value")), "n").alias("first"))
    order = Window.partitionBy("file").orderBy("block")
    before = F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return per.select("file", "block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("odd"),
                      F.first("first", ignorenulls=True).over(order).cast("binary").alias("header"))


def _names(header: bytes) -> list[str]:
    return next(csv.reader([header.decode("utf-8-sig")], strict=True), [])


class _Range:
    """The lines of one byte range, in order: whole records and at most two fragments."""

    def __init__(self, file: str, block: int, odd: bool, header: bytes):
        self.file, self.block, self.header = file, block, header
        self.open, self.held = odd, []
        self.rec = -1 if odd else 0

    def add(self, line: bytes):
        """(record number, its bytes) when ``line`` ends a record."""
        self.held.append(line)
        if line.count(b'"') % 2:
            self.open = not self.open
        if self.open:
            return None
        done = self.rec, b"\n".join(self.held)
        self.held, self.rec = [], self.rec + 1
        return done


def _rows(file, block, header, records: list[tuple[int, bytes]]) -> list[dict]:
    """Records as log columns; the header's own record and blank lines are left out."""
    csv.field_size_limit(2**31 - 1)
    at = {c: i for i, c in enumerate(_names(header))}
    texts = [r.decode("utf-8-sig" if block == 0 and n == 0 else "utf-8") for n, r in records]
    out = []
    for (n, _), text in zip(records, texts):
        values = next(csv.reader([text], strict=True), [])
        if (block == 0 and n == 0) or not values:
            continue
        row = {c: values[at[c]] if at[c] < len(values) else None for c in LOG_CSV_COLUMNS}
        out.append({"file": file, "block": block, "rec": n, **row, "header": None, "fragment": None})
    return out


def _walk(batches, fragments: bool):
    """Whole records (or, with ``fragments``, only what the ends of ranges hold)."""
    current, done, out = None, [], []

    def fragment(rec: int, data: bytes) -> dict:
        return dict.fromkeys(LOG_CSV_COLUMNS) | {"file": current.file, "block": current.block, "rec": rec,
                                                 "header": current.header, "fragment": data}

    def flush():
        nonlocal done, out
        if not fragments and current:
            out += _rows(current.file, current.block, current.header, done)
        rows, done, out = out, [], []
        return [pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)] if rows else []

    for batch in batches:
        files, blocks, odds, headers, lines = (c.to_pylist() for c in batch.columns)
        for file, block, odd, header, line in zip(files, blocks, odds, headers, lines):
            if current is None or (current.file, current.block) != (file, block):
                if current and current.held and fragments:
                    out.append(fragment(current.rec, b"\n".join(current.held)))
                yield from flush()
                current = _Range(file, block, odd, header)
            found = current.add(line)
            if found and found[0] < 0:
                if fragments:
                    out.append(fragment(*found))
            elif found and not fragments:
                done.append(found)
                if len(done) >= RECORDS:
                    yield from flush()
    if current:
        if current.held and fragments:
            out.append(fragment(current.rec, b"\n".join(current.held)))
        yield from flush()


def _whole(batches):
    """Records that were put together from fragments."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            rows += _rows(r["file"], r["block"], r["header"], [(r["rec"], b"\n".join(r["parts"]))])
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, rec, the six log columns) of every record of the CSV files at ``path``;
    ``block + rec`` grows with the order in a file."""
    lines = _lines(spark, path)
    known = materialize(ranges(lines), "csv-ranges")
    for r in known.filter("block = 0").select("header").distinct().toLocalIterator():
        if bytes(r.header).count(b'"') % 2:
            raise ValueError(f"the header of {path} has a line break in a quoted name")
        header_gate(_names(bytes(r.header)))
    if known.count() <= BROADCAST_RANGES:
        joined = lines.join(F.broadcast(known), ["file", "block"])
    else:
        joined = lines.join(known, ["file", "block"]).repartition("file", "block") \
            .sortWithinPartitions("file", "block", "n")
    rows = joined.select("file", "block", "odd", "header", F.col("value").cast("binary").alias("value"))
    whole = rows.mapInArrow(lambda b: _walk(b, False), _SQL)
    ends = rows.mapInArrow(lambda b: _walk(b, True), _SQL)
    # a fragment belongs to the record that was begun last before it
    order = Window.partitionBy("file").orderBy("block", "rec")
    begun = F.last(F.when(F.col("rec") >= 0, F.struct("block", "rec")), ignorenulls=True).over(order)
    pieces = ends.select("file", "block", "rec", "header", "fragment", begun.alias("owner"))
    joined_up = pieces.groupBy("file", "owner").agg(
        F.any_value("header").alias("header"),
        F.transform(F.array_sort(F.collect_list(F.struct("block", "rec", "fragment"))), lambda x: x.fragment).alias("parts"))
    joined_up = joined_up.select("file", F.col("owner.block").alias("block"), F.col("owner.rec").alias("rec"),
                                 "header", "parts").mapInArrow(_whole, _SQL)
    return whole.unionByName(joined_up).drop("header", "fragment")


def read_log_csv_splits(spark: SparkSession, path: str, blank_as: str = "pending",
                        run_id: str = IMPORTED) -> DataFrame:
    """What ``logs.read_log_csv`` returns, with every file read by as many tasks as it
    has byte ranges."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(f"no translation log at {path}")
    status = fs.getFileStatus(target)
    if status.isFile() and status.getLen() == 0:
        raise ValueError(f"the translation log {path} has no header")
    df = read_csv_records(spark, path)
    name = F.element_at(F.split("file", "/"), -1)
    text = F.coalesce("translated_text", F.lit(""))
    blank = "preview" if blank_as == "pending" else "translated"
    return df.select(
        F.concat(F.lit(run_id + ":"), name).alias("run_id"), (F.col("block") + F.col("rec")).alias("batch_id"),
        F.lit(0).alias("pos"), F.lit(0).alias("variant_idx"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("filepath", "string_key")],
        F.when(F.col("string_id") != "", F.col("string_id")).alias("string_id"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("field", "source_text")], text.alias("translated_text"),
        F.when(text == "", F.lit(blank)).otherwise(F.lit("translated")).alias("status"))
