"""Resume: drop entries that the translation log already holds.

The log can be as large as the entries table, so the join is a shuffle anti join on
the entry key by default.  The log side is first reduced to its distinct keys (partial
aggregation before the shuffle), so a key repeated in the log never multiplies rows;
a hot key on the entries side is split by AQE's skew-join handling, which supports
left-anti joins.  Whether the key side is broadcast is decided by AQE at run time from
the measured size of the distinct keys (``spark.sql.adaptive.autoBroadcastJoinThreshold``),
with the shuffle join beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENTRY_KEY, key_match

def normalize_ids(df: DataFrame) -> DataFrame:
    """An empty ``string_id`` means "no id" on both sides."""
    return df.withColumn("string_id", F.when(F.col("string_id") == "", F.lit(None))
                                        .otherwise(F.col("string_id")))


def done_keys(log: DataFrame, translated_only: bool = True, distinct: bool = True) -> DataFrame:
    """Distinct entry keys present in the log (``distinct=False``: one per row).  With ``translated_only`` the preview
    rows (``status = 'preview'``) do not count as done (T1)."""
    if translated_only and "status" in log.columns:
        log = log.filter(F.col("status") == "translated")
    keys = normalize_ids(log.select(*ENTRY_KEY))
    return keys.distinct() if distinct else keys


def pending(entries: DataFrame, log: DataFrame | None, translated_only: bool = True) -> DataFrame:
    """Entries whose (filepath, string_key, string_id, field) is not in the log,
    comparing NULL ids as equal.  Ids come out normalised with or without a log."""
    e = normalize_ids(entries)
    if log is None:
        return e
    keys = done_keys(log, translated_only)
    return e.join(keys, key_match(e, keys), "left_anti")


def done_key_count(log: DataFrame, translated_only: bool = True) -> DataFrame:
    """A3: number of distinct done keys (one row)."""
    return done_keys(log, translated_only).agg(F.count(F.lit(1)).alias("n_done_keys"))
