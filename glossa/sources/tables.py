"""Reading the driver's tables and the views derived from them.

The driver provides generic tables (``documents``, ``conversations``, ``pages`` ...).
The views below turn them into localization inputs with the shapes the reference
handles: two gendered variants per entry, NULL ids, colliding keys, blank variants and
a partial translation log.  They are plain projections, so Catalyst prunes the
unused columns at the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import balance

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A driver table; with ``spread``, a scan with fewer partitions than cores is
    redistributed before heavy per-row work (see :func:`glossa.session.balance`)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return balance(df) if spread else df


def raw_entries(documents: DataFrame) -> DataFrame:
    """One locale entry per document: female text = the document, male text derived.

    filepath groups documents by (lang, source); ids are NULL for every 7th document;
    keys repeat every 5 documents, so NULL ids make entry keys collide.
    """
    d = documents
    return d.select(
        F.concat(F.lit("loc/"), d.lang, F.lit("-"), d.lang, F.lit("/"), d.source,
                 F.lit(".json.json")).alias("filepath"),
        d.doc_id.cast("int").alias("entry_idx"),
        F.concat(F.lit("k"), (d.doc_id % 5).cast("string")).alias("string_key"),
        F.when(d.doc_id % 7 == 0, F.lit(None).cast("string"))
         .otherwise(d.doc_id.cast("string")).alias("string_id"),
        d.text.alias("female"),
        F.when(d.doc_id % 3 == 0, d.text)
         .when(d.doc_id % 3 == 1, F.concat(d.text, F.lit(" (m)")))
         .otherwise(F.lit("   ")).alias("male"),
    )


def log_from_entries(entries: DataFrame, every: int = 5, prefix: str = "[xx] ") -> DataFrame:
    """A partial translation log: the female variant of every ``every``-th entry."""
    e = entries
    return (e.filter((e.entry_idx % every == 0) & (e.variant_idx == 0))
             .select("filepath", "string_key", "string_id", "field", "source_text",
                     F.concat(F.lit(prefix), e.source_text).alias("translated_text"),
                     "entry_idx", "variant_idx"))


def _q(col):
    """JSON string literal of a text column (``to_json`` of a one-element array, unwrapped)."""
    j = F.to_json(F.array(col))
    return F.substr(j, F.lit(2), F.length(j) - 2)


def json_documents(documents: DataFrame) -> DataFrame:
    """One locale document (JSON text) per ``documents`` row, covering the shapes and
    field cases of the extraction rules:

    * key (doc_id % 5): secondaryKey text | secondaryKey null + $type | $type only |
      neither | secondaryKey false
    * id ((doc_id div 5) % 5): integer | missing | null | string | float ``<id>.5``
    * male variant (doc_id % 6): same text | blank | number | null | missing | other text
    * shape (doc_id % 4): nested wrapper with a Header sibling | flat ``entries`` |
      bare list with two non-object items first | nested non-list with flat fallback
    * doc_id % 50 = 7: truncated JSON; = 17: trailing junk; = 27: leading BOM.

    Columns: doc_id, filepath, content (STRING).
    """
    d = documents
    k5, i5, m6, s4 = d.doc_id % 5, F.floor(d.doc_id / 5) % 5, d.doc_id % 6, d.doc_id % 4
    sid = d.doc_id.cast("string")
    key = (F.when(k5 == 0, F.concat(F.lit('"secondaryKey": "sk'), sid, F.lit('"')))
            .when(k5 == 1, F.lit('"secondaryKey": null, "$type": "T1"'))
            .when(k5 == 2, F.concat(F.lit('"$type": "type'), (d.doc_id % 3).cast("string"), F.lit('"')))
            .when(k5 == 4, F.lit('"secondaryKey": false')))
    ident = (F.when(i5 == 0, F.concat(F.lit('"stringId": '), sid))
              .when(i5 == 2, F.lit('"stringId": null'))
              .when(i5 == 3, F.concat(F.lit('"stringId": "s'), sid, F.lit('"')))
              .when(i5 == 4, F.concat(F.lit('"stringId": '), sid, F.lit(".5"))))
    female = F.concat(F.lit('"femaleVariant": '), _q(d.text))
    male = (F.when(m6 == 0, F.concat(F.lit('"maleVariant": '), _q(d.text)))
             .when(m6 == 1, F.lit('"maleVariant": "   "'))
             .when(m6 == 2, F.lit('"maleVariant": 12345'))
             .when(m6 == 3, F.lit('"maleVariant": null'))
             .when(m6 == 5, F.concat(F.lit('"maleVariant": '), _q(F.concat(d.text, F.lit(" (m)"))))))
    entry = F.concat(F.lit("{"), F.concat_ws(", ", key, ident, female, male), F.lit("}"))
    # one projection per step, so the entry text is built once and not copied into
    # every shape branch
    d = d.select("doc_id", "lang", "source", entry.alias("entry"))
    s4, entry = d.doc_id % 4, F.col("entry")
    doc = (F.when(s4 == 0, F.concat(
                F.lit('{"Header": {"v": 1}, "Data": {"RootChunk": {"root": {"Data": {"entries": ['),
                entry, F.lit("]}}}}}")))
            .when(s4 == 1, F.concat(F.lit('{"entries": ['), entry, F.lit('], "extra": true}')))
            .when(s4 == 2, F.concat(F.lit('["junk", 7, '), entry, F.lit("]")))
            .otherwise(F.concat(
                F.lit('{"Data": {"RootChunk": {"root": {"Data": {"entries": {"x": 1}}}}}, "entries": ['),
                entry, F.lit("]}"))))
    d = d.select("doc_id", "lang", "source", doc.alias("doc"))
    bad, doc = d.doc_id % 50, F.col("doc")
    content = (F.when(bad == 7, F.lit('{"entries": ['))
                .when(bad == 17, F.concat(doc, F.lit(" junk")))
                .when(bad == 27, F.concat(F.lit("\ufeff"), doc))
                .otherwise(doc))
    path = F.concat(F.lit("loc/"), d.lang, F.lit("-"), d.lang, F.lit("/"), d.source, F.lit("/"),
                    sid, F.lit(".json.json"))
    return d.select("doc_id", path.alias("filepath"), content.alias("content"))
