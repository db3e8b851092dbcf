"""Replies: provider envelope -> reply text -> validated items.

Everything is a column expression; the reply text is parsed into a VARIANT with
Spark's JSON parser.  The steps are split into separate projections that each compute
one intermediate column, which keeps the generated code small.

Python rule being reproduced (reply parse):
  strip; drop an opening code fence line (or just the three backticks when there is no
  newline) and a closing fence; parse strictly; if that fails, parse the JSON array
  that starts at the first '[' (the reference tries closing brackets from the right,
  and the only one that can succeed is the one matching that '['); the value must be
  an array of exactly ``n`` scalars; scalars are rendered with Python ``str``.

Known difference: Python accepts NaN/Infinity in JSON, Spark does not (the reply is
then ``invalid_json``).  Floats are rendered exactly as Python's ``repr``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_rstrip, py_str_variant, py_strip
from .extract import strict_json

# --- fixed values -------------------------------------------------------------------
FENCE = "```"
# a JSON string literal (unrolled, possessive: linear and without deep recursion)
JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
STATUS_OK = "ok"
# ------------------------------------------------------------------------------------


def envelope_text(provider: str, raw_col: str = "raw") -> tuple[F.Column, F.Column]:
    """(text, status) from a provider's JSON reply envelope.

    A truncated reply (stop at the output cap) and, for the openai shape, a NULL
    content (refusal) are errors.
    """
    v = F.try_parse_json(F.col(raw_col))
    if provider == "anthropic":
        text = F.try_variant_get(v, "$.content[0].text", "string")
        status = (F.when(v.isNull(), F.lit("invalid_envelope"))
                   .when(F.try_variant_get(v, "$.stop_reason", "string") == "max_tokens",
                         F.lit("truncated"))
                   .when(text.isNull(), F.lit("invalid_envelope")))
    elif provider == "openai":
        text = F.try_variant_get(v, "$.choices[0].message.content", "string")
        status = (F.when(v.isNull(), F.lit("invalid_envelope"))
                   .when(F.try_variant_get(v, "$.choices[0].finish_reason", "string") == "length",
                         F.lit("truncated"))
                   .when(text.isNull(), F.lit("refused")))
    else:
        raise ValueError(f"Unknown provider: {provider!r}")
    return text, status


def unfence(text: F.Column) -> F.Column:
    """R2 part 1: strip, remove code fences (Python slicing rules)."""
    t = py_strip(text)
    nl = F.instr(t, "\n")
    opened = (F.when(~t.startswith(FENCE), t)
               .when(nl == 0, F.substr(t, F.lit(4)))
               .otherwise(F.substr(t, nl + 1)))
    return F.when(opened.endswith(FENCE),
                  py_rstrip(F.substr(opened, F.lit(1), F.length(opened) - 3))).otherwise(opened)


def parse_replies(df: DataFrame, text_col: str = "reply", n_col: str = "n") -> DataFrame:
    """R2-R4 on a table with a reply text column and the expected count.

    Adds ``status`` (ok | invalid_json | not_array | wrong_count | nested_item),
    ``error`` and ``items`` ARRAY<STRING> (NULL unless ok).  A NULL reply keeps the
    status already present in the input column ``status`` if any, else
    ``invalid_json``.
    """
    prior = F.col("status") if "status" in df.columns else F.lit(None).cast("string")
    s1 = df.withColumn("_body", unfence(F.col(text_col)))
    whole = strict_json(F.col("_body"))
    start = F.instr(F.col("_body"), "[")
    fallback = F.when(start > 0, F.try_parse_json(F.substr(F.col("_body"), start)))
    s2 = s1.withColumn("_v", F.coalesce(whole, fallback))
    arr = F.col("_v").try_cast("array<variant>")
    s3 = s2.withColumn("_arr", arr)
    # The skeleton is the array's canonical JSON with every string literal emptied; an
    # item is nested iff '[' or '{' remains inside the outer brackets.  This keeps the
    # status free of lambdas, so filters on it stay in generated code.
    skeleton = F.regexp_replace(F.to_json(F.col("_arr")), JSON_STRING, '""')
    s3 = s3.withColumn("_skel", skeleton)
    inner = F.substr(F.col("_skel"), F.lit(2), F.length("_skel") - 2)
    nested = inner.rlike(r"[\[{]")
    status = (F.when(prior.isNotNull(), prior)
               .when(F.col(text_col).isNull() | F.col("_v").isNull(), F.lit("invalid_json"))
               .when(F.col("_arr").isNull(), F.lit("not_array"))
               .when(F.size("_arr") != F.col(n_col), F.lit("wrong_count"))
               .when(nested, F.lit("nested_item"))
               .otherwise(F.lit(STATUS_OK)))
    s4 = s3.withColumn("status", status)
    error = (F.when(F.col("status") == "not_array", F.concat(
                 F.lit("Expected JSON array, got "), F.schema_of_variant("_v")))
              .when(F.col("status") == "wrong_count", F.concat(
                 F.lit("Expected "), F.col(n_col).cast("string"), F.lit(" translations, got "),
                 F.size("_arr").cast("string")))
              .when(F.col("status") == "nested_item", F.lit("Translation item is not a scalar"))
              .when(F.col("status") == "invalid_json", F.lit("Reply is not valid JSON")))
    out = s4.withColumn("error", F.when(F.col("error").isNotNull(), F.col("error"))
                        .otherwise(error) if "error" in df.columns else error)
    # all-string replies (the normal case) are read natively; only replies with other
    # scalars go through the per-item Python ``str`` rendering
    all_strings = F.col("_skel").rlike(r'^\[(""(,"")*)?\]$')
    items = (F.when(all_strings, F.from_json(F.to_json(F.col("_arr")), "array<string>"))
              .otherwise(F.transform("_arr", lambda x: py_str_variant(x))))
    out = out.withColumn("items", F.when(F.col("status") == STATUS_OK, items))
    return out.drop("_body", "_v", "_arr", "_skel")


def explode_items(parsed: DataFrame, keep=("batch_id",)) -> DataFrame:
    """J4 input: one row per (batch_id, pos, translated_text) of the ok replies.

    ``items`` is NULL unless the reply is ok.  Filters on ``status`` or ``items``
    would be pushed below the parse projections with the parse inlined into them
    (Catalyst also infers ``size(items) > 0`` for a plain ``posexplode``), so the
    outer form is used and the filter is on the generated ``pos``, which stays above.
    """
    return (parsed.select(*keep, F.posexplode_outer("items").alias("pos", "translated_text"))
                  .filter(F.col("pos").isNotNull())
                  .withColumn("pos", F.col("pos").cast("int")))
