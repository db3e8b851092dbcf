"""Requests: one prompt and one provider body per batch.

A batch holds at most ``batch_size`` units, so ``collect_list`` per batch is bounded
by the batch size, not by the data.  The prompt is assembled with ``transform`` and
``array_join`` on the JVM; the text of each unit is JSON-quoted exactly as Python's
``json.dumps(..., ensure_ascii=False)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.models import MAX_OUTPUT_TOKENS, TOKEN_CAP_FIELD, resolve_model
from ..functions.text import json_quote

# --- fixed values -------------------------------------------------------------------
# Prompt template.  {source_lang}, {target_lang}, {title} and {n} are filled in.
PROMPT_HEAD = (
    "Translate the following {source_lang} dialogue strings from {title} into {target_lang}.",
    "",
    "Rules:",
    "- Preserve all HTML/XML tags (e.g. <color>, </i>) exactly as they appear.",
    "- Preserve all {{variable}} placeholders (e.g. {{player_name}}) exactly as they appear.",
    "- Maintain the tone, register, and character voice of each line.",
    "- femaleVariant is text shown for a female player character; maleVariant is for male. Adjust gendered grammar if the target language requires it.",  # noqa: E501
    "- The secondaryKey gives context about who is speaking and the scene.",
    "- Return ONLY a JSON array of translated strings, one per input, in the same order.",
    "- Do NOT include any explanation, markdown formatting, or code fences.",
    "",
    "Input strings:",
    "",
)
TEXT_INDENT = "    "
DEFAULT_TITLE = "the game"
# ------------------------------------------------------------------------------------


def prompt_head(source_lang: str, target_lang: str, title: str = DEFAULT_TITLE) -> list[str]:
    return [line.format(source_lang=source_lang, target_lang=target_lang, title=title)
            for line in PROMPT_HEAD]


def batch_items(units: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Group batched units: (batch_id, n, items ARRAY<STRUCT> sorted by pos)."""
    item = F.struct(F.col("pos"), F.col("string_key"), F.col("field"), F.col("source_text"),
                    *[F.col(c) for c in extra])
    return (units.groupBy("batch_id")
                 .agg(F.array_sort(F.collect_list(item)).alias("items"))
                 .withColumn("n", F.size("items")))


def prompt_column(source_lang: str, target_lang: str, title: str = DEFAULT_TITLE,
                  items: str = "items", n: str = "n") -> F.Column:
    """B1: the prompt text of a batch as one column expression."""
    head = F.array(*[F.lit(x) for x in prompt_head(source_lang, target_lang, title)])
    body = F.flatten(F.transform(F.col(items), lambda x: F.array(
        F.concat(F.lit("["), x.pos.cast("string"), F.lit("] (key: "), x.string_key,
                 F.lit(", field: "), x.field, F.lit(")")),
        F.concat(F.lit(TEXT_INDENT), json_quote(x.source_text)),
        F.lit(""))))
    tail = F.array(F.concat(F.lit("Return a JSON array of exactly "), F.col(n).cast("string"),
                            F.lit(" translated strings.")))
    return F.array_join(F.concat(head, body, tail), "\n")


def body_column(provider: str, model_col, prompt_col) -> F.Column:
    """B2: the provider request body (model, output cap 8192, one user message)."""
    cap = TOKEN_CAP_FIELD[provider]
    return F.to_json(F.struct(
        model_col.alias("model"), F.lit(MAX_OUTPUT_TOKENS).alias(cap),
        F.array(F.struct(F.lit("user").alias("role"), prompt_col.alias("content")))
        .alias("messages")))


def body_for(provider_col, model_col, prompt_col) -> F.Column:
    """B2 when the provider is a column: resolve the model (P13), pick the body shape."""
    resolved = resolve_model(provider_col, model_col)
    return (F.when(provider_col == "openai", body_column("openai", resolved, prompt_col))
             .otherwise(body_column("anthropic", resolved, prompt_col)))


#: Columns of a unit that become part of its log record, beside those of the prompt.
RECORD_FIELDS = ("filepath", "string_id", "variant_idx", "is_dedup")


def build_requests(units: DataFrame, source_lang: str, target_lang: str, provider: str,
                   model: str, title: str = DEFAULT_TITLE, parallelism: int | None = None,
                   keep_units: bool = False) -> DataFrame:
    """requests(batch_id, n, prompt, provider, model, body, texts).

    The units are spread by batch over the tasks that make the calls (see ``infer``), so
    each text moves once; the prompt and body, which repeat it, are built where they are
    used.  ``keep_units`` adds the batch's units in order, which the results carry on."""
    from ..functions.models import check_provider
    check_provider(provider)
    tasks = parallelism or units.sparkSession.sparkContext.defaultParallelism
    b = batch_items(units.repartition(tasks, "batch_id"), RECORD_FIELDS if keep_units else ())
    prompt = prompt_column(source_lang, target_lang, title)
    return b.select(
        *([F.col("items").alias("units")] if keep_units else []),
        "batch_id", "n", prompt.alias("prompt"), F.lit(provider).alias("provider"),
        resolve_model(F.lit(provider), F.lit(model)).alias("model"),
        F.transform("items", lambda x: x.source_text).alias("texts"),
    ).withColumn("body", body_column(provider, F.col("model"), F.col("prompt")))
