"""Quality gates and counters.

Each gate is an aggregate over a table that yields one row; only that row reaches the
driver, where the decision (warn or raise) is made.  The rate gate is strict: exactly
10 % passes (T18).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LOG_CSV_COLUMNS

log = logging.getLogger(__name__)

# --- fixed values -------------------------------------------------------------------
MAX_FAILURE_PCT = 10.0
# ------------------------------------------------------------------------------------


class GateError(RuntimeError):
    """A gate stopped the job."""


def failure_rates(outcomes: DataFrame, ok_col: str = "ok", by: list[str] | None = None,
                  max_pct: float = MAX_FAILURE_PCT) -> DataFrame:
    """A8/A10 as a table: total, failed, pct, too_high (pct > max_pct), all_failed."""
    ok = F.col(ok_col)
    agg = [F.count(F.lit(1)).alias("total"), F.count_if(~ok).alias("failed")]
    g = outcomes.groupBy(*by).agg(*agg) if by else outcomes.agg(*agg)
    pct = F.when(F.col("total") > 0,
                 F.col("failed").cast("double") * 100 / F.col("total")).otherwise(F.lit(0.0))
    return (g.withColumn("pct", pct)
             .withColumn("too_high", F.col("pct") > max_pct)
             .withColumn("all_failed", (F.col("total") > 0) & (F.col("failed") == F.col("total"))))


def failure_rate_gate(outcomes: DataFrame, ok_col: str = "ok", max_pct: float = MAX_FAILURE_PCT,
                      what: str = "conversion") -> dict:
    """Warn when anything failed, raise when the failure rate exceeds ``max_pct``."""
    row = failure_rates(outcomes, ok_col, None, max_pct).first().asDict()
    if row["failed"]:
        log.warning("%s: %d/%d failed (%.1f%%)", what, row["failed"], row["total"], row["pct"])
    if row["too_high"]:
        raise GateError(f"{what} failure rate too high: {row['failed']}/{row['total']} "
                        f"({row['pct']:.1f}%)")
    return row


def all_failed_gate(outcomes: DataFrame, ok_col: str = "ok", what: str = "unbundle") -> dict:
    """A10: raise only when every source failed."""
    row = failure_rates(outcomes, ok_col).first().asDict()
    if row["all_failed"]:
        raise GateError(f"All {row['total']} {what} source(s) failed")
    if row["failed"]:
        log.warning("%s: %d/%d failed", what, row["failed"], row["total"])
    return row


def header_gate(columns, required=LOG_CSV_COLUMNS) -> None:
    """Required columns minus present columns must be empty (schema metadata only)."""
    absent = [c for c in required if c not in columns]
    if absent:
        raise ValueError(f"a translation log needs the columns {', '.join(required)}; absent: {', '.join(absent)}")


def zero_update_gate(apply_counts: DataFrame) -> dict:
    """Nothing applied means the output would be untranslated: stop publishing."""
    row = apply_counts.first().asDict()
    if not row["n_updated"]:
        raise GateError("0 translations were applied; refusing to publish")
    return row


def non_empty_gate(df: DataFrame, what: str) -> None:
    """An empty input (no locale files, no output archives) is an error."""
    if df.isEmpty():
        raise GateError(f"No {what} found")


def conversion_outcomes(raw: DataFrame, converted: DataFrame) -> DataFrame:
    """A8's input: (filepath, ok) per raw file; a raw file without its converted file
    (its path with one more ``.json``) failed.  Both are listings: paths, no bodies."""
    done = converted.select(F.regexp_replace("filepath", r"\.json$", "").alias("filepath")).distinct() \
                    .withColumn("ok", F.lit(True))
    return raw.select("filepath").join(done, "filepath", "left") \
              .select("filepath", F.coalesce("ok", F.lit(False)).alias("ok"))


def output_count(df: DataFrame, what: str = "outputs") -> DataFrame:
    """A count as a metric row."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("value")).select(
        F.lit(what).alias("metric"), "value")
