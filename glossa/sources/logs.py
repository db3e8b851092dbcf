"""Translation log import (S6, S8, P10, T1, T19) and the working log table.

CSV options mirror Python's ``csv`` module: RFC 4180 quoting with doubled quotes,
quoted newlines, UTF-8 with an optional BOM, header row; extra columns and any column
order are accepted, missing required columns are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gates import header_gate
from ..operators.records import IMPORTED
from ..session import file_system

CSV_OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"',
    "encoding": "UTF-8", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false", "mode": "FAILFAST",
}


def read_log_csv(spark: SparkSession, path: str, blank_as: str = "pending",
                 run_id: str = IMPORTED) -> DataFrame:
    """Read a log CSV into the working-log schema.

    ``string_id`` '' -> NULL; ``translated_text`` NULL -> ''.  Rows with an empty
    translation are previews (``blank_as='pending'``, default) or done
    (``blank_as='done'``, the reference's behaviour, T1).  "Last record wins" needs the
    order of the log: ``run_id`` carries the name of the part file (an export numbers its
    parts in log order) and ``batch_id`` grows within a file (a multi-line CSV file is
    not split, so one task reads it in order).
    """
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(f"no translation log at {path}")
    status = fs.getFileStatus(target)
    if status.isFile() and status.getLen() == 0:
        raise ValueError(f"the translation log {path} has no header")
    df = spark.read.options(**CSV_OPTIONS).csv(path)
    names = [c.lstrip("\ufeff") for c in df.columns]
    header_gate(names)
    df = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)],
                   F.col("_metadata.file_name").alias("__part"))
    blank_status = "preview" if blank_as == "pending" else "translated"
    t = F.coalesce(F.col("translated_text"), F.lit(""))
    return df.select(
        F.concat(F.lit(run_id + ":"), "__part").alias("run_id"),
        F.monotonically_increasing_id().alias("batch_id"),
        F.lit(0).alias("pos"),
        F.lit(0).alias("variant_idx"),
        F.coalesce("filepath", F.lit("")).alias("filepath"),
        F.coalesce("string_key", F.lit("")).alias("string_key"),
        F.when(F.col("string_id") == "", F.lit(None)).otherwise(F.col("string_id")).alias("string_id"),
        F.coalesce("field", F.lit("")).alias("field"),
        F.coalesce("source_text", F.lit("")).alias("source_text"),
        t.alias("translated_text"),
        F.when(t == "", F.lit(blank_status)).otherwise(F.lit("translated")).alias("status"))


def read_log_table(spark: SparkSession, path: str) -> DataFrame:
    """The working log (Parquet, partitioned by run)."""
    return spark.read.parquet(path)
