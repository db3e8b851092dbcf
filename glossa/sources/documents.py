"""Locale documents on storage.

``binaryFile`` lists and reads files on the executors.  Selecting only ``path``
prunes ``content``, so listings never read file bodies; the glob filter and the
locale predicate run before any content is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import is_locale_path, relative_to
from ..session import exists

# --- fixed values -------------------------------------------------------------------
CONVERTED_GLOB = "*.json.json"
RAW_GLOB = "*.json"
# ------------------------------------------------------------------------------------


def _scan(spark: SparkSession, root: str, glob: str) -> DataFrame:
    return (spark.read.format("binaryFile")
                 .option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", glob)
                 .load(root))


def list_documents(spark: SparkSession, root: str, locale: str | None = None) -> DataFrame:
    """S1 listing: converted documents (``*.json.json``) under ``root``; with a
    locale, only paths with a component equal to it (P1, on the relative path, T12).
    Returns (filepath) relative to ``root`` -- no file body is read."""
    df = _scan(spark, root, CONVERTED_GLOB).select(relative_to(F.col("path"), root).alias("filepath"))
    if locale:
        df = df.filter(is_locale_path(F.col("filepath"), locale))
    return df


def read_documents(spark: SparkSession, root: str, locale: str | None = None) -> DataFrame:
    """S1 + read: (filepath, content BINARY) of the converted documents."""
    require_dir(spark, root)
    df = _scan(spark, root, CONVERTED_GLOB).select(
        relative_to(F.col("path"), root).alias("filepath"), "content")
    if locale:
        df = df.filter(is_locale_path(F.col("filepath"), locale))
    return df


def list_raw_documents(spark: SparkSession, root: str, locale: str | None = None) -> DataFrame:
    """``*.json`` files that are not ``*.json.json`` (inputs of the conversion).
    An empty result is a warning for the caller, not an error."""
    df = _scan(spark, root, RAW_GLOB).select(relative_to(F.col("path"), root).alias("filepath"))
    df = df.filter(~F.col("filepath").endswith(".json.json"))
    if locale:
        df = df.filter(is_locale_path(F.col("filepath"), locale))
    return df


def require_dir(spark: SparkSession, path: str) -> str:
    """Re-reading extracted files needs the folder to exist."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no folder of extracted documents at {path}")
    return path


def read_documents_from(spark: SparkSession, roots: list[str], locale: str | None = None) -> DataFrame:
    """Documents of several search folders (e.g. base content and an expansion),
    each path relative to its own root; folders that do not exist are skipped."""
    frames = []
    for root in roots:
        if not exists(spark, root):
            continue
        frames.append(read_documents(spark, root, locale)
                      .withColumn("root", F.lit(root)))
    if not frames:
        raise FileNotFoundError(f"none of the folders exist: {roots}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
