"""WARC archives whose repeated payloads are revisit records.

*Writing.*  Only headers (id, url, payload digest and length) are shuffled by digest: of
equal payloads of at least ``min_bytes`` bytes the record with the smallest id is the
response, the others refer to it.  The few header columns of the revisits are written and
joined back to the pages; each record gets fresh headers, in archives of about
``ARCHIVE_BYTES``.  Records are written as gzip files by Spark's text writer
(a record's block is HTTP headers and the payload, all UTF-8).

*Reading.*  Each archive is parsed by Content-Length, never by searching for a separator,
so payloads may contain anything.  Digests are recomputed from the payload.  A revisit
gets digest and length of its full payload by a join with the response it refers to.

Defined results: a null payload is empty; a null or odd url is written percent-encoded,
or left out; a null id is written as an empty field and read back as null (of several
equal payloads, a null id is never the response unless all ids are null); repeated rows
are revisits of the same response; an empty table makes an empty archive folder and an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize, scratch_path

ARCHIVE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    h = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(key: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _clean(url: Column) -> Column:
    """A url fit for a header line: blanks and control characters percent-encoded."""
    out = url.cast("string")
    for c in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    odd = url.cast("string").rlike(r"[\x00-\x20\x7F]")
    return F.when(odd, out).otherwise(url.cast("string"))


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Every (id, digest) that has a record beside a plain response: id, digest, first
    (whether the response of its payload is among its rows), times (rows), first_id,
    first_url.  Only header columns are shuffled, combined before the shuffle."""
    keys = materialize(pages.groupBy("id", base32_sha1(F.col("payload")).alias("digest"),
                                     F.octet_length("payload").cast("long").alias("n_bytes"))
                            .agg(F.count("*").alias("times"), F.min("url").alias("url")), "warc-headers")
    firsts = (keys.filter(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
                  .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "url")).alias("f"))
                  .select("digest", "n_bytes", F.col("f.id").alias("first_id"), F.col("f.url").alias("first_url")))
    joined = keys.join(firsts, ["digest", "n_bytes"])
    first = F.col("id").eqNullSafe(F.col("first_id"))
    return joined.filter(~first | (F.col("times") > 1)).select("id", "digest", first.alias("first"), "times",
                                                               "first_id", "first_url")


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit(_END)), F.lit(""))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, date: str = DATE) -> None:
    """Write the pages as deduplicated WARC archives under ``path``."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    heads = materialize(resolve(rows, min_bytes), "warc-resolved")
    count, total = rows.agg(F.count("*"), F.sum(F.octet_length("payload"))).first()
    per_file = max(1, int(count * ARCHIVE_BYTES / max(total or 0, 1)))
    keyed = rows.withColumn("digest", base32_sha1(F.col("payload")))

    def own(df, how):
        """``df`` with its header columns; a written table that Spark broadcasts if small."""
        h = heads.withColumnsRenamed({"id": "hid", "digest": "hdigest"})
        return df.join(h, df["id"].eqNullSafe(h["hid"]) & (df["digest"] == h["hdigest"]), how)

    both = own(keyed, "left").filter(F.coalesce("times", F.lit(1)) == 1).withColumn("nth", F.lit(1)) \
        .withColumn("revisit", F.col("times").isNotNull())
    if not heads.filter("times > 1").isEmpty():
        # rows that share id and payload: the first of them by url may be the response
        rank = F.row_number().over(W.partitionBy("id", "digest").orderBy("url"))
        again = own(keyed, "inner").filter("times > 1").withColumn("nth", rank)
        both = both.unionByName(again.withColumn("revisit", ~F.col("first") | (F.col("nth") > 1)))
    both = both.withColumn("n_bytes", F.octet_length("payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.concat_ws("#", F.coalesce(F.col("id").cast("string"), F.lit("")),
                                                         F.col("digest"), F.col("nth").cast("string")))),
        _header("WARC-Page-ID", F.coalesce(F.col("id").cast("string"), F.lit(""))),
        _header("WARC-Target-URI", _clean(F.col("url"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(
            _header("WARC-Profile", F.lit(PROFILE)),
            _header("WARC-Refers-To", _record_id(F.concat_ws("#", F.coalesce(F.col("first_id").cast("string"), F.lit("")),
                                                             F.col("digest"), F.lit("1")))),
            _header("WARC-Refers-To-Target-URI", _clean(F.col("first_url"))))).otherwise(F.lit("")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(F.col("block"))),
        F.lit(_END), F.col("block"))
    (both.withColumn("block", block).select(record.alias("value"))
         .write.option("lineSep", _END + _END).option("compression", "gzip")
         .option("maxRecordsPerFile", per_file).mode("errorifexists").text(path))


def parse_archive(data: bytes):
    """(headers, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(b": ", 1) for line in lines[1:])
        size = int(headers[b"Content-Length"])
        yield headers, data[stop + 4:stop + 4 + size]
        at = stop + 4 + size + 4


_RECORD = "page_id bigint, record_id string, record_type string, url string, refers_to_id string, " \
          "digest string, payload_bytes bigint, payload binary"


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives under ``path`` (``payload`` only on request)."""
    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for h, block in parse_archive(gzip.decompress(content.as_py())):
                    text = {k: v.decode() for k, v in h.items()}
                    payload = block[block.index(b"\r\n\r\n") + 4:]
                    digest = text[b"WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = text[b"WARC-Type"]
                    if kind == "response" and digest != base64.b32encode(hashlib.sha1(payload).digest()).decode():
                        raise ValueError(f"digest of {text[b'WARC-Record-ID']} differs from its payload")
                    rows.append((int(text[b"WARC-Page-ID"]) if text[b"WARC-Page-ID"] else None,
                                 text[b"WARC-Record-ID"], kind, text.get(b"WARC-Target-URI"),
                                 text.get(b"WARC-Refers-To"), digest,
                                 len(payload) if kind == "response" else None,
                                 payload if with_payload and kind == "response" else None))
                cols = list(zip(*rows)) or [()] * 8
                kinds = [pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)],
                    names=[f.split()[0] for f in _RECORD.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, _RECORD)


def resolved_records(records: DataFrame) -> DataFrame:
    """Every record with its full payload's length and digest, revisits by their response."""
    # parsed once, for both sides of the join; the payloads stay out
    records = materialize(records.drop("payload"), "warc-records")
    first = records.filter("record_type = 'response'").select(
        F.col("record_id").alias("first"), F.col("page_id").alias("first_page"), F.col("payload_bytes").alias("first_bytes"),
        F.col("digest").alias("first_digest"))
    joined = records.join(first, records["refers_to_id"] == first["first"], "left")
    return joined.select("page_id", F.coalesce("payload_bytes", "first_bytes").alias("payload_bytes"),
                         F.coalesce("first_digest", "digest").alias("payload_digest"), "record_type",
                         F.col("first_page").alias("refers_to"))


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Write every page to archives, read them back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return resolved_records(read_records(spark, path))


#: DuckDB has sha1 as hex only; base32 comes from the digest's 40 groups of 4 bits.
ORACLE_SQL = """
with p as (
  select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages
), d as (
  select page_id, octet_length(encode(t)) as n,
         (select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 cast((cast(('0x' || substr(h, 1 + 5 * (i // 4), 5)) as bigint) >> (15 - 5 * (i % 4))) & 31 as int) + 1, 1), '' order by i)
          from range(32) r(i)) as digest
  from p
), f as (
  select *, min(page_id) over (partition by digest, n) as first from d
)
select page_id, n as payload_bytes, digest as payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from f
"""
