"""Source selection, limits and the package manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import glob_to_like, not_voice, path_parts
from .batching import global_index

# --- fixed values -------------------------------------------------------------------
PRIMARY_ARCHIVE = "lang_{code}_text.archive"
FALLBACK_ARCHIVE_GLOB = "*lang_{code}*.archive"
PACKAGE_DIR = "archive/pc/mod"
# ------------------------------------------------------------------------------------


def select_sources(listing: DataFrame, code: str, dir_col: str = "dir",
                   name_col: str = "name") -> DataFrame:
    """S3: per directory the primary archive if present there, else every archive that
    matches the fallback glob and is not a voice archive.

    "Has a primary" is a per-directory ``max`` (map-side combined, one row per
    directory) joined back, rather than a window, so a directory holding most of the
    listing is never sorted in one task.
    """
    name = F.col(name_col)
    primary = PRIMARY_ARCHIVE.format(code=code)
    like = glob_to_like(FALLBACK_ARCHIVE_GLOB.format(code=code))
    cand = listing.filter((name == primary) | (name.like(like) & not_voice(name)))
    cand = cand.withColumn("_is_primary", name == primary)
    per_dir = cand.groupBy(dir_col).agg(F.max("_is_primary").alias("_has_primary"))
    return (cand.join(per_dir, dir_col)
                .filter(F.col("_is_primary") == F.col("_has_primary"))
                .drop("_is_primary", "_has_primary"))


def first_files(paths: DataFrame, limit: int | None, path_col: str = "filepath") -> DataFrame:
    """The first ``max(1, min(limit, n_files))`` paths in component order; all
    paths when ``limit`` is not positive.  The limit is the feature (a top-k)."""
    if limit is None or limit <= 0:
        return paths
    return paths.orderBy(path_parts(path_col)).limit(max(1, limit))


def limit_documents(docs: DataFrame, limit: int | None) -> DataFrame:
    """O2 + W3 (T14): the documents of the first files of the *listing*, whether or not
    they hold entries.  The cap needs paths only, so bodies of other files are not parsed."""
    if limit is None or limit <= 0:
        return docs
    return docs.join(first_files(docs.select("filepath").distinct(), limit), "filepath", "left_semi")


def limit_entries(entries: DataFrame, limit: int | None) -> DataFrame:
    """O3: the first entries in (file, entry, variant) order, of documents that
    :func:`limit_documents` has capped before.  ``TakeOrderedAndProject`` keeps only
    ``limit`` rows per task."""
    if limit is None or limit <= 0:
        return entries
    return entries.orderBy(path_parts("filepath"), "entry_idx", "variant_idx").limit(limit)


def manifest(archives: DataFrame, mod_name: str, name_col: str = "name") -> DataFrame:
    """K6: packaged name per archive: ``<mod>.archive``, then ``<mod>_1.archive`` ...
    in name order, under the package folder.  Numbered with the distributed index."""
    idx = global_index(archives.select(name_col).distinct(), [F.col(name_col)], "_i")
    suffix = F.when(F.col("_i") > 0, F.concat(F.lit("_"), F.col("_i").cast("string"))) \
        .otherwise(F.lit(""))
    return idx.select(name_col, F.concat(F.lit(f"{PACKAGE_DIR}/{mod_name}"), suffix,
                                         F.lit(".archive")).alias("package_path"))
