"""Extraction: locale documents -> flat table of translatable strings.

A locale document is one JSON value per file.  Parsing happens on the executors with
Spark's VARIANT functions; the entry array is exploded with its position, the key,
the id and the two variants are read with missing-vs-null fidelity, and blank or
non-string variants are dropped.  VARIANT values never reach a shuffle: every column
leaving this module is a STRING or INT.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_text, py_str_variant
from ..session import balance
from ..schemas import VARIANT_FIELDS

# --- fixed values -------------------------------------------------------------------
# Where the entry array sits in a converted locale document, then the two fallbacks.
NESTED_ENTRIES_PATH = "$.Data.RootChunk.root.Data.entries"
FLAT_ENTRIES_PATH = "$.entries"
ENTRY_LOCATIONS = (NESTED_ENTRIES_PATH, FLAT_ENTRIES_PATH, "$")
KEY_FIELD = "secondaryKey"
KEY_FALLBACK_FIELD = "$type"
KEY_DEFAULT = "unknown"
ID_FIELD = "stringId"
# ------------------------------------------------------------------------------------


def decode_text(content: Column) -> Column:
    """UTF-8 bytes -> text, NULL when the bytes are not valid UTF-8; one leading BOM
    is removed (Python's ``utf-8-sig``)."""
    text = F.try_validate_utf8(content.cast("string"))
    return F.regexp_replace(text, r"^\x{FEFF}", "")


def strict_json(text: Column) -> Column:
    """Parse ``text`` as exactly one JSON value (Python ``json.loads``), else NULL.

    ``try_parse_json`` accepts trailing text after the first value.  ``text`` is one
    complete value iff ``[text]`` is an array of one element and ``{"v":text}`` is an
    object with one key; each wrapper catches the bracket tricks the other misses.
    """
    as_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).try_cast("array<variant>")
    as_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    one_key = F.size(as_object.try_cast("map<string,variant>")) == 1
    return F.when((F.size(as_array) == 1) & one_key, F.element_at(as_array, 1))


def locate_entries(doc: Column) -> Column:
    """Nested entry list if it is a list, else top-level ``entries`` if a list,
    else the document itself if it is a list, else an empty list."""
    return F.coalesce(
        F.try_variant_get(doc, NESTED_ENTRIES_PATH, "array<variant>"),
        F.try_variant_get(doc, FLAT_ENTRIES_PATH, "array<variant>"),
        doc.try_cast("array<variant>"),
        F.array().cast("array<variant>"),
    )


def entry_list(data) -> list:
    """The entry list of a document parsed by Python's ``json``: the first of
    ENTRY_LOCATIONS that holds a list, else an empty list."""
    for path in ENTRY_LOCATIONS:
        found = data
        for step in path.split(".")[1:]:
            found = found.get(step) if isinstance(found, dict) else None
        if isinstance(found, list):
            return found
    return []


def _entry_json(entry) -> str:
    """The fields of one entry that extraction reads, as JSON text; NaN and infinities,
    which only Python's ``json`` accepts, become their text."""
    if not isinstance(entry, dict):
        return "null"
    kept = {}
    for name in (KEY_FIELD, KEY_FALLBACK_FIELD, ID_FIELD, *VARIANT_FIELDS):
        if name in entry:
            value = entry[name]
            if name in VARIANT_FIELDS and not isinstance(value, str):
                value = None  # only texts are translated
            try:
                json.dumps(value, allow_nan=False)
            except ValueError:
                value = str(value)
            kept[name] = value
    return json.dumps(kept, ensure_ascii=False)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _entries_beyond_variant(text: pd.Series) -> pd.Series:
    """Entries of documents that ``try_parse_json`` refuses though Python accepts them:
    larger than one VARIANT may be, or holding NaN.  NULL for text that is no JSON."""
    def entries(t):
        if t is None:
            return None
        try:
            return [_entry_json(e) for e in entry_list(json.loads(t))]
        except (ValueError, RecursionError):
            return None
    return text.map(entries, na_action="ignore").astype(object).where(text.notna(), None)


def parse_documents(docs: DataFrame, content_col: str = "content") -> DataFrame:
    """(filepath, content) -> (filepath, doc VARIANT, entries array<variant>, reason).
    ``reason`` is NULL for good files, ``invalid_utf8`` or ``invalid_json`` otherwise
    (quarantine).  The size limit of a VARIANT holds per entry, not per document: a
    document that is not parsed natively gets a second chance entry by entry."""
    # JSON objects with duplicate keys parse like Python's json (the last one wins)
    docs.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    content = F.col(content_col)
    if dict(docs.dtypes)[content_col] == "binary":
        text = decode_text(content)
    else:
        text = F.regexp_replace(content, r"^\x{FEFF}", "")
    parsed = docs.select("filepath", text.alias("_text"))
    parsed = parsed.select("filepath", "_text", strict_json(F.col("_text")).alias("doc"))
    # only refused texts travel to Python; the others are NULL there
    parsed = parsed.withColumn("_more", _entries_beyond_variant(
        F.when(F.col("doc").isNull(), F.col("_text"))))
    more = F.transform("_more", lambda e: F.try_parse_json(e))
    return parsed.select(
        "filepath", "doc", F.when(F.col("_more").isNotNull(), more).alias("more"),
        F.when(F.col("_text").isNull(), F.lit("invalid_utf8"))
         .when(F.col("doc").isNull() & F.col("_more").isNull(), F.lit("invalid_json")).alias("reason"))


def entries_of(doc: str = "doc", more: str = "more") -> Column:
    """Entry list of a parsed document, however it was parsed."""
    return F.coalesce(F.col(more), locate_entries(F.col(doc)))


def quarantine(parsed: DataFrame, stage: str = "extract") -> DataFrame:
    """Files that could not be read (T8: one table shared by extraction and apply)."""
    # the filter stands on a generated column, so it is not pushed into the parse
    bad = parsed.select("filepath", F.explode(F.array("reason")).alias("reason"))
    return (bad.filter(F.col("reason").isNotNull())
               .select("filepath", F.lit(stage).alias("stage"), "reason"))


def _field(en: Column, name: str) -> Column:
    # bracket form keeps names such as "$type" literal
    return F.variant_get(en, f"$['{name}']", "variant")


def extract_entries(docs: DataFrame, content_col: str = "content") -> DataFrame:
    """Documents -> entries (filepath, entry_idx, variant_idx, field, string_key,
    string_id, source_text).  Unreadable files produce no rows (see :func:`quarantine`).
    """
    # parsing is the heavy step: a listing that landed in few partitions is spread first
    parsed = parse_documents(balance(docs), content_col)
    # No filter on the parse result: Catalyst would push it (and the size filter it
    # infers for a plain posexplode) below the projections and the spread, evaluating
    # the parse twice in one oversized generated method.  A bad file has a NULL doc,
    # whose entry list is empty; the outer explode yields one NULL row per such file,
    # removed by a filter on the generated position, which stays above the generator.
    exploded = (parsed.select("filepath", F.posexplode_outer(entries_of())
                              .alias("entry_idx", "en"))
                      .filter(F.col("entry_idx").isNotNull()))
    en = F.col("en")
    # Only objects are entries
    objects = exploded.filter(F.schema_of_variant(en).startswith("OBJECT"))
    # P5: secondaryKey if the key exists (even as null), else $type if it exists, else
    # "unknown".  variant_get gives SQL NULL for a missing key and a VARIANT null for a
    # present null, so coalesce implements "exists".
    key = F.coalesce(_field(en, KEY_FIELD), _field(en, KEY_FALLBACK_FIELD),
                     F.parse_json(F.lit(f'"{KEY_DEFAULT}"')))
    sid = _field(en, ID_FIELD)
    keyed = objects.select(
        "filepath", F.col("entry_idx").cast("int").alias("entry_idx"),
        py_str_variant(key).alias("string_key"),
        # Missing or JSON null -> NULL, else str(value)
        # and '' is no id (T19), from here on in every key
        F.when((F.schema_of_variant(sid) == "VOID") | (sid.try_cast("string") == ""),
               F.lit(None).cast("string"))
         .otherwise(py_str_variant(sid)).alias("string_id"),
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("variant_idx"), F.lit(f).alias("field"),
                     _field(en, f).alias("val"))
            for i, f in enumerate(VARIANT_FIELDS)])).alias("v"))
    val = F.col("v.val")
    # JSON strings that are not blank in Python's sense
    kept = keyed.filter((F.schema_of_variant(val) == "STRING") & has_text(val.cast("string")))
    return kept.select("filepath", "entry_idx", F.col("v.variant_idx").alias("variant_idx"),
                       F.col("v.field").alias("field"), "string_key", "string_id",
                       val.cast("string").alias("source_text"))


def unpivot_variants(raw: DataFrame, female: str = "female", male: str = "male",
                     keep=("filepath", "entry_idx", "string_key", "string_id")) -> DataFrame:
    """P7 + P8 on a table that already holds the two variants as text columns.

    ``stack`` unpivots in the fixed order female (0), male (1); blank or NULL variants
    are dropped with Python's ``strip`` rule.
    """
    cols = [F.col(c) for c in keep]
    long = raw.select(*cols, F.expr(
        f"stack(2, 0, '{VARIANT_FIELDS[0]}', `{female}`, 1, '{VARIANT_FIELDS[1]}', `{male}`)"
        " AS (variant_idx, field, source_text)"))
    return (long.filter(F.col("source_text").isNotNull() & has_text("source_text"))
                .select(*keep, "variant_idx", "field", "source_text"))


def extraction_metrics(docs: DataFrame, content_col: str = "content") -> DataFrame:
    """A4 in one pass: entries extracted, files read, files skipped (metric rows).

    One outer explode gives exactly one row per document without entries and one row
    per entry otherwise; each row carries the number of variants it contributes, so
    a single global aggregate (partial per task) yields all three counters."""
    parsed = parse_documents(balance(docs), content_col)
    ex = parsed.select("reason", F.posexplode_outer(entries_of())
                       .alias("entry_idx", "en"))
    en = F.col("en")
    is_obj = F.coalesce(F.schema_of_variant(en).startswith("OBJECT"), F.lit(False))
    kept = F.lit(0)
    for f in VARIANT_FIELDS:
        val = _field(en, f)
        ok = is_obj & (F.schema_of_variant(val) == "STRING") & has_text(val.cast("string"))
        kept = kept + F.coalesce(ok, F.lit(False)).cast("int")
    agg = ex.agg(F.sum(kept).cast("long").alias("entries"),
                 F.count_if((F.col("entry_idx").isNull() | (F.col("entry_idx") == 0))
                            & F.col("reason").isNull()).cast("long").alias("files"),
                 F.count_if(F.col("reason").isNotNull()).cast("long").alias("files_skipped"))
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value"))
        for c in ("entries", "files", "files_skipped")])).alias("m")).select("m.*")
