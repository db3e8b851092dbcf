"""Table schemas and key helpers shared by every stage.

Entry key (D5) = (filepath, string_key, string_id, field) where ``string_id`` may be
NULL and NULL equals NULL (the reference compares Python tuples).  Group key (D6)
drops ``field``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# --- fixed values -------------------------------------------------------------------
# The two translatable fields of a locale entry, in the order they are processed.
VARIANT_FIELDS = ("femaleVariant", "maleVariant")
DEFAULT_BATCH_SIZE = 40
# ------------------------------------------------------------------------------------

ENTRY_KEY = ("filepath", "string_key", "string_id", "field")
GROUP_KEY = ("filepath", "string_key", "string_id")

ENTRIES = T.StructType([
    T.StructField("filepath", T.StringType(), False),
    T.StructField("entry_idx", T.IntegerType(), False),
    T.StructField("variant_idx", T.IntegerType(), False),
    T.StructField("field", T.StringType(), False),
    T.StructField("string_key", T.StringType(), False),
    T.StructField("string_id", T.StringType(), True),
    T.StructField("source_text", T.StringType(), False),
])

LOG_CSV_COLUMNS = ("filepath", "string_key", "string_id", "field",
                   "source_text", "translated_text")

TRANSLATION_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("variant_idx", T.IntegerType(), False),
    T.StructField("filepath", T.StringType(), False),
    T.StructField("string_key", T.StringType(), False),
    T.StructField("string_id", T.StringType(), True),
    T.StructField("field", T.StringType(), False),
    T.StructField("source_text", T.StringType(), False),
    T.StructField("translated_text", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
])

RESPONSES = T.StructType([
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("n", T.IntegerType(), False),
    T.StructField("attempt", T.IntegerType(), False),
    T.StructField("raw", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])


def key_match(left: DataFrame, right: DataFrame, cols=ENTRY_KEY) -> Column:
    """Null-safe equality on a composite key (``<=>`` on the nullable ``string_id``)."""
    conds = [left[c].eqNullSafe(right[c]) if c == "string_id" else left[c] == right[c]
             for c in cols]
    return reduce(lambda a, b: a & b, conds)

RUN_METRICS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), False),
])
