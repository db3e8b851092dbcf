"""Translation records and the log.

The working log is a Parquet table partitioned by ``run_id`` (append one partition
per run instead of rewriting the whole file after every batch, T17).  Its order
columns ``(run_id, batch_id, pos, variant_idx)`` reproduce the reference's record
order, which decides "last record wins" on apply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENTRY_KEY
from ..session import TEXT_CODEC
from .dedup import expand_dedup
from .replies import explode_items
from .resume import normalize_ids

#: Run ids of records read from a CSV log start like this; the file's name follows.
IMPORTED = "imported"
LOG_ORDER = ("run_id", "batch_id", "pos", "variant_idx")
LOG_COLUMNS = ("run_id", "batch_id", "pos", "variant_idx", "filepath", "string_key",
               "string_id", "field", "source_text", "translated_text", "status")


def records_from_results(units: DataFrame, results: DataFrame, run_id: str) -> DataFrame:
    """J4 + J3: zip each ok batch with its units by (batch_id, pos), then add the male
    copy of every deduped pair.  Returns log rows with ``status = 'translated'``.  Results
    that carry their units are zipped in place, without a join."""
    if "units" in results.columns:
        pairs = results.select("batch_id", F.explode(F.arrays_zip("units", "items")).alias("z"))
        zipped = pairs.select("batch_id", "z.units.*", F.col("z.items").alias("translated_text"))
    else:
        zipped = units.join(explode_items(results), ["batch_id", "pos"])
    expanded = expand_dedup(zipped)
    return expanded.select(
        F.lit(run_id).alias("run_id"), F.col("batch_id").cast("long").alias("batch_id"),
        F.col("pos").cast("int").alias("pos"), F.col("variant_idx").cast("int").alias("variant_idx"),
        "filepath", "string_key", "string_id", "field", "source_text", "translated_text",
        F.lit("translated").alias("status"))


def preview_records(entries: DataFrame, run_id: str) -> DataFrame:
    """Every entry with an empty translation, ``status = 'preview'``."""
    return entries.select(
        F.lit(run_id).alias("run_id"), F.lit(-1).cast("long").alias("batch_id"),
        F.col("entry_idx").cast("int").alias("pos"), F.col("variant_idx").cast("int"),
        "filepath", "string_key", "string_id", "field", "source_text",
        F.lit("").alias("translated_text"), F.lit("preview").alias("status"))


def append_log(records: DataFrame, log_path: str) -> None:
    """K2: append new rows only, one partition directory per run."""
    (records.select(*LOG_COLUMNS).write.mode("append").option("compression", TEXT_CODEC)
            .partitionBy("run_id").parquet(log_path))


def run_rank(run_id: str = "run_id"):
    """Sort key of a run: imported records come before those of any run, runs by their id
    (dated ids sort by time; a stream's ids start with the date of its start, too)."""
    r = F.col(run_id)
    return F.struct((~r.startswith(IMPORTED)).alias("own"), r.alias("id"))


def latest_per_key(log: DataFrame, order=LOG_ORDER) -> DataFrame:
    """The last record per entry key (``max_by`` over the log order).  NULL ids
    group together.  Map-side combined: a hot key costs one row per partition."""
    o = F.struct(*[run_rank() if c == "run_id" else F.col(c) for c in order])
    payload = F.struct(F.col("translated_text"), F.col("source_text"))
    # '' and NULL ids are one key, so they must be one before the grouping
    return (normalize_ids(log).groupBy(*ENTRY_KEY)
               .agg(F.max_by(payload, o).alias("_last"))
               .select(*ENTRY_KEY, F.col("_last.translated_text").alias("translated_text"),
                       F.col("_last.source_text").alias("log_source_text")))


def run_counts(log: DataFrame, run_id: str) -> DataFrame:
    """New records of this run and total records (one row)."""
    return log.agg(F.count_if(F.col("run_id") == run_id).alias("n_new"),
                   F.count(F.lit(1)).alias("n_total"))


def keep_translated(log: DataFrame) -> DataFrame:
    """Resume and apply use translated rows only; previews live in the same schema
    but never count as done (T1)."""
    return log.filter(F.col("status") == "translated") if "status" in log.columns else log


def union_logs(*logs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = logs[0]
    for other in logs[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
