"""Quality reports the reference asks for but does not compute.

X1 checks that markup tags and ``{placeholder}`` tokens survive translation, X2 flags
translations much longer than their source, X3 finds log rows whose source text has
changed since they were translated (T10), X4 previews the work per file, X5 joins the
small locale table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import key_match
from .records import latest_per_key
from .resume import normalize_ids

# --- fixed values -------------------------------------------------------------------
TAG = r"<[^<>]+>"
PLACEHOLDER = r"\{[A-Za-z_][A-Za-z0-9_]*\}"
# Common locales: language, locale folder.  The archive name follows the rule
# lang_<code>_text.archive with code = text before the first '-'.
LOCALES = (
    ("English", "en-us"),
    ("Turkish", "tr-tr"),
    ("Russian", "ru-ru"),
    ("Japanese", "ja-jp"),
    ("Chinese (Simplified)", "zh-cn"),
    ("Korean", "ko-kr"),
    ("Polish", "pl-pl"),
    ("German", "de-de"),
    ("French", "fr-fr"),
    ("Spanish", "es-es"),
    ("Italian", "it-it"),
    ("Portuguese (Brazil)", "pt-br"),
    ("Czech", "cz-cz"),
    ("Hungarian", "hu-hu"),
    ("Arabic", "ar-ar"),
    ("Thai", "th-th"),
)
# ------------------------------------------------------------------------------------


def markup_report(df: DataFrame, src: str = "source_text", tgt: str = "translated_text") -> DataFrame:
    """Tag and placeholder multisets of source and translation, and whether they
    agree."""
    def toks(c, pat):
        return F.array_sort(F.regexp_extract_all(F.col(c), F.lit(pat), 0))
    return df.select(
        "*",
        F.size(toks(src, TAG)).alias("n_src_tags"), F.size(toks(tgt, TAG)).alias("n_tgt_tags"),
        (toks(src, TAG) == toks(tgt, TAG)).alias("tags_ok"),
        (toks(src, PLACEHOLDER) == toks(tgt, PLACEHOLDER)).alias("placeholders_ok"))


def length_ratio(df: DataFrame, src: str = "source_text", tgt: str = "translated_text",
                 max_ratio: float = 1.5) -> DataFrame:
    """length(translation) / length(source) and an overflow flag."""
    # an empty source has no ratio
    ratio = F.try_divide(F.length(tgt).cast("double"), F.length(src))
    return df.withColumn("ratio", ratio).withColumn("too_long", F.col("ratio") > max_ratio)


#: Size of a quantile sketch: about 0.35 % of rank error, and exact up to so many values.
SKETCH_K = 800


def ratio_sketches(df: DataFrame, keys=("run_id", "filepath"), k: int = SKETCH_K) -> DataFrame:
    """X2 per run: ``keys``, n and a quantile sketch of the length ratios (a few KB however
    many strings a file has, combined before the shuffle).  Kept per run, sketches of
    later runs are merged without reading the log again."""
    rated = length_ratio(df).filter(F.col("ratio").isNotNull())
    return rated.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.kll_sketch_agg_double("ratio", F.lit(k)).alias("sketch"))


def ratio_percentiles(sketches: DataFrame, per=("filepath",), percents=(50, 90, 99)) -> DataFrame:
    """``per``, n and one column ``p<percent>`` for each, from merged sketches: the least
    ratio that so many percent of the strings do not exceed."""
    merged = sketches.groupBy(*per).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_all"))
    return merged.select(*per, "n", *[F.kll_sketch_get_quantile_double("_all", F.lit(p / 100)).alias(f"p{p}")
                                      for p in percents])


def stale_translations(entries: DataFrame, log: DataFrame) -> DataFrame:
    """Entries whose latest log record was made from a different source text."""
    lt = latest_per_key(log)
    e = normalize_ids(entries)
    j = e.join(lt, key_match(e, lt), "inner")
    return j.select(*[e[c] for c in e.columns], lt["log_source_text"],
                    (lt["log_source_text"] != e["source_text"]).alias("stale"))


def cost_preview(entries: DataFrame, batch_size: int = 40) -> DataFrame:
    """Strings and characters per file with a grand total (rollup), and the
    batches the strings would need at ``batch_size`` (per file, rounded up)."""
    g = entries.rollup("filepath").agg(
        F.count(F.lit(1)).alias("n_strings"),
        F.sum(F.length("source_text")).cast("long").alias("n_chars"))
    return g.withColumn("n_batches", F.ceil(F.col("n_strings") / batch_size).cast("long"))


def locale_table(spark) -> DataFrame:
    """The locale dimension (code, language, locale, archive); 16 fixed rows."""
    from ..functions.paths import locale_code
    from .selection import PRIMARY_ARCHIVE
    df = spark.createDataFrame(list(LOCALES), "language string, locale string")
    code = locale_code(F.col("locale"))
    return df.select(code.alias("code"), "language", "locale",
                     F.replace(F.lit(PRIMARY_ARCHIVE), F.lit("{code}"), code).alias("archive"))


def with_locales(df: DataFrame, locales: DataFrame, code_col: str = "code") -> DataFrame:
    """Attach the locale dimension (a fixed table of 16 rows, broadcast)."""
    return df.join(F.broadcast(locales), code_col, "left")
