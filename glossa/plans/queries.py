"""Registered queries: each reads the driver's tables at ``sf_dir`` and returns a
DataFrame; ``ORACLES`` holds the DuckDB SQL that must give the same rows.

Every query runs over whole tables.  Column names and types are aliased identically
on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, extract, records, resume
from ..operators.qa import LOCALES
from ..sources import tables
from . import oracles as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- shared inputs ------------------------------------------------------------------

def fixture_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> raw_entries -> long form."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return extract.unpivot_variants(tables.raw_entries(docs))


def fixture_log(entries: DataFrame) -> DataFrame:
    return tables.log_from_entries(entries)


def fixture_log_table(entries: DataFrame) -> DataFrame:
    """The fixture's log as rows of the working log (run r0)."""
    return fixture_log(entries).select(
        F.lit("r0").alias("run_id"), F.col("entry_idx").cast("long").alias("batch_id"),
        F.lit(0).alias("pos"), "variant_idx", "filepath", "string_key", "string_id", "field",
        "source_text", "translated_text", F.lit("translated").alias("status"))


def fixture_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = fixture_entries(spark, sf_dir)
    return resume.pending(entries, fixture_log(entries))


# --- M1: tables ---------------------------------------------------------------------

@register("q_pending_per_file", O.with_(*O.BASE) + """
SELECT p.filepath, CAST(p.n_pending AS BIGINT) AS n_pending,
       CAST(g.n_groups AS BIGINT) AS n_groups, CAST(g.n_deduped AS BIGINT) AS n_deduped,
       CAST(g.n_units AS BIGINT) AS n_units
FROM (SELECT filepath, count(*) AS n_pending FROM pending GROUP BY filepath) p
JOIN (SELECT filepath, count(*) AS n_groups,
             sum(CASE WHEN f_idx IS NOT NULL AND m_idx IS NOT NULL AND f_text = m_text
                      THEN 1 ELSE 0 END) AS n_deduped,
             sum(CASE WHEN f_idx IS NOT NULL AND m_idx IS NOT NULL AND f_text = m_text THEN 1
                      ELSE (f_idx IS NOT NULL)::INT + (m_idx IS NOT NULL)::INT END) AS n_units
      FROM groups GROUP BY filepath) g ON p.filepath = g.filepath
""")
def q_pending_per_file(spark, sf_dir):
    """Flagship: pending translation units per file.  Unpivot, null-safe
    anti join, last-wins grouping and pair dedup."""
    p = fixture_pending(spark, sf_dir)
    g = dedup.group_entries(p)
    f, m = F.col("female"), F.col("male")
    dd = f.isNotNull() & m.isNotNull() & (f.source_text == m.source_text)
    per_group = g.groupBy("filepath").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.count_if(dd).alias("n_deduped"),
        F.sum(F.when(dd, F.lit(1)).otherwise(f.isNotNull().cast("int") + m.isNotNull().cast("int")))
         .cast("long").alias("n_units"))
    per_file = p.groupBy("filepath").agg(F.count(F.lit(1)).alias("n_pending"))
    return per_file.join(per_group, "filepath").select(
        "filepath", "n_pending", "n_groups", "n_deduped", "n_units")


@register("q_extract_long", O.with_(O.RAW_ENTRIES, O.ENTRIES) + """
SELECT filepath, entry_idx, variant_idx, field, string_key, string_id, source_text
FROM entries
""")
def q_extract_long(spark, sf_dir):
    """Two variants per entry in long form; blank variants dropped."""
    return fixture_entries(spark, sf_dir).select(
        "filepath", "entry_idx", "variant_idx", "field", "string_key", "string_id",
        "source_text")


@register("q_resume_pending", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG, O.PENDING) + """
SELECT filepath, entry_idx, variant_idx, field, string_key, string_id FROM pending
""")
def q_resume_pending(spark, sf_dir):
    """Entries not yet in the log (null-safe key)."""
    return fixture_pending(spark, sf_dir).select(
        "filepath", "entry_idx", "variant_idx", "field", "string_key", "string_id")


@register("q_done_keys", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG) + """
SELECT CAST(count(*) AS BIGINT) AS n_done_keys
FROM (SELECT DISTINCT filepath, string_key, string_id, field FROM log) k
""")
def q_done_keys(spark, sf_dir):
    """A3: distinct done keys of the log."""
    return resume.done_key_count(fixture_log(fixture_entries(spark, sf_dir)))


@register("q_pair_dedup", O.with_(*O.BASE, O.UNITS) + """
SELECT filepath, string_key, string_id, first_entry_idx, variant_idx, field, entry_idx,
       source_text, is_dedup
FROM units
""")
def q_pair_dedup(spark, sf_dir):
    """A1, A2: last duplicate wins per group and field; identical pairs sent once."""
    return dedup.plan_units(fixture_pending(spark, sf_dir))


@register("q_plan_counts", O.with_(*O.BASE) + """
SELECT 'n_pending' AS metric, CAST(count(*) AS BIGINT) AS value FROM pending
UNION ALL SELECT 'n_groups', CAST(count(*) AS BIGINT) FROM groups
UNION ALL SELECT 'n_deduped', CAST(count(*) FILTER (WHERE f_idx IS NOT NULL AND m_idx IS NOT NULL
                                                 AND f_text = m_text) AS BIGINT) FROM groups
UNION ALL SELECT 'n_units', CAST(sum(CASE WHEN f_idx IS NOT NULL AND m_idx IS NOT NULL
                                           AND f_text = m_text THEN 1
                                      ELSE (f_idx IS NOT NULL)::INT + (m_idx IS NOT NULL)::INT
                                      END) AS BIGINT) FROM groups
""")
def q_plan_counts(spark, sf_dir):
    """A5: plan counters (pending, groups, deduped pairs, units)."""
    return dedup.plan_counts(fixture_pending(spark, sf_dir))


# --- M3: batches and requests -------------------------------------------------------

BATCH_SIZE = 40


def fixture_batches(spark, sf_dir, batch_size: int = BATCH_SIZE) -> DataFrame:
    from ..operators import batching
    units = dedup.plan_units(fixture_pending(spark, sf_dir))
    return batching.assign_batches(units, batching.unit_order(), batch_size)


@register("q_batches", O.with_(*O.BASE, O.UNITS, O.NUMBERED) + f"""
SELECT filepath, string_key, string_id, field, CAST(idx AS BIGINT) AS unit_idx,
       CAST(idx // {BATCH_SIZE} AS BIGINT) AS batch_id, CAST(idx % {BATCH_SIZE} AS INTEGER) AS pos
FROM numbered
""")
def q_batches(spark, sf_dir):
    """Contiguous batches of 40 units in unit order, numbered without a
    single-partition window."""
    return fixture_batches(spark, sf_dir).select(
        "filepath", "string_key", "string_id", "field", "unit_idx", "batch_id", "pos")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PROMPT_ARGS = ("English", "Kazakh")


def conversation_units(spark, sf_dir, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Conversation turns as translation units, batched in (conv_id, turn) order."""
    from ..operators import batching
    c = tables.read_table(spark, sf_dir, "conversations")
    units = c.select("conv_id", "turn",
                     F.concat(F.lit("conv"), F.col("conv_id").cast("string"), F.lit("/"),
                              F.col("turn").cast("string")).alias("string_key"),
                     F.col("role").alias("field"), F.col("text").alias("source_text"))
    return batching.assign_batches(units, [F.col("conv_id"), F.col("turn")], batch_size)


CONV_BATCHES = f"""
WITH t AS (
  SELECT conv_id, turn, role, text, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx
  FROM conversations
), b AS (
  SELECT idx // {BATCH_SIZE} AS batch_id, idx % {BATCH_SIZE} AS pos,
         'conv' || conv_id || '/' || turn AS k, role AS f, text FROM t
), p AS (
  SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n,
         {{head}} || chr(10)
         || string_agg('[' || pos || '] (key: ' || k || ', field: ' || f || ')' || chr(10)
                       || '    ' || to_json(text) || chr(10), chr(10) ORDER BY pos)
         || chr(10) || 'Return a JSON array of exactly ' || count(*) || ' translated strings.'
         AS prompt
  FROM b GROUP BY batch_id
)
"""


def _conv_prompt_sql() -> str:
    from ..operators.requests import prompt_head
    return CONV_BATCHES.replace("{head}", _sql_text("\n".join(prompt_head(*PROMPT_ARGS))))


@register("q_prompt", _conv_prompt_sql() + "SELECT batch_id, n, prompt FROM p")
def q_prompt(spark, sf_dir):
    """B1: one prompt per batch of 40 conversation turns (rules, numbered items with
    JSON-quoted text, closing count)."""
    from ..operators import requests as rq
    b = rq.batch_items(conversation_units(spark, sf_dir))
    return b.select("batch_id", "n", rq.prompt_column(*PROMPT_ARGS).alias("prompt"))


MODEL_CHOICES = ("claude-sonnet-4-20250514", "gpt-4o", "o1-preview", "o3-mini",
                 "my-custom-model", "claude-3-haiku")


@register("q_request_body", _conv_prompt_sql() + """,
r AS (
  SELECT batch_id, prompt,
         CASE batch_id % 2 WHEN 0 THEN 'anthropic' ELSE 'openai' END AS provider,
         CASE batch_id % 6 """ + " ".join(
    f"WHEN {i} THEN {_sql_text(m)}" for i, m in enumerate(MODEL_CHOICES)) + """ END AS model_in
  FROM p
), m AS (
  SELECT *, CASE
      WHEN provider = 'openai' AND starts_with(model_in, 'claude') THEN 'gpt-4o'
      WHEN provider = 'anthropic' AND (starts_with(model_in, 'gpt') OR starts_with(model_in, 'o1')
           OR starts_with(model_in, 'o3') OR starts_with(model_in, 'o4'))
        THEN 'claude-sonnet-4-20250514'
      ELSE model_in END AS model
  FROM r
)
SELECT batch_id, provider, model_in, model,
       CASE provider
         WHEN 'openai' THEN json_object('model', model, 'max_completion_tokens', 8192,
              'messages', json_array(json_object('role', 'user', 'content', prompt)))::VARCHAR
         ELSE json_object('model', model, 'max_tokens', 8192,
              'messages', json_array(json_object('role', 'user', 'content', prompt)))::VARCHAR
       END AS body
FROM m
""")
def q_request_body(spark, sf_dir):
    """Provider body per batch with the model reconciled to the provider."""
    from ..functions.models import resolve_model
    from ..operators import requests as rq
    b = rq.batch_items(conversation_units(spark, sf_dir))
    p = b.select("batch_id", rq.prompt_column(*PROMPT_ARGS).alias("prompt"))
    provider = F.when(F.col("batch_id") % 2 == 0, F.lit("anthropic")).otherwise(F.lit("openai"))
    model_in = F.element_at(F.array(*[F.lit(m) for m in MODEL_CHOICES]),
                            (F.col("batch_id") % len(MODEL_CHOICES) + 1).cast("int"))
    r = p.select("batch_id", "prompt", provider.alias("provider"), model_in.alias("model_in"))
    r = r.withColumn("model", resolve_model(F.col("provider"), F.col("model_in")))
    return r.select("batch_id", "provider", "model_in", "model",
                    rq.body_for(F.col("provider"), F.col("model_in"), F.col("prompt")).alias("body"))


# --- M4: replies --------------------------------------------------------------------

def _doc_replies(spark, sf_dir) -> DataFrame:
    """Replies built around known items: fences, preambles, trailing notes, scalars."""
    d = tables.read_table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    two = F.to_json(F.array(F.col("text"), F.concat(F.lit("x"), F.col("doc_id").cast("string"))))
    scalars = F.concat(F.lit("["), F.col("doc_id").cast("string"),
                       F.lit(", true, null, 1.5, 1e20, 1.0, 12345678.0, 0.0001, "),
                       F.to_json(F.array("text")).substr(F.lit(2), F.length(F.to_json(F.array("text"))) - 2),
                       F.lit("]"))
    k = F.col("doc_id") % 6
    reply = (F.when(k == 0, two)
              .when(k == 1, F.concat(F.lit("```json\n"), two, F.lit("\n```")))
              .when(k == 2, F.concat(F.lit("```"), two, F.lit("```")))
              .when(k == 3, F.concat(F.lit("Below, in order:\n"), two))
              .when(k == 4, F.concat(two, F.lit("\n(Names such as [guard] stay.)")))
              .otherwise(scalars))
    n = F.when(k == 5, F.lit(9)).otherwise(F.lit(2))
    return d.select("doc_id", reply.alias("reply"), n.alias("n"))


@register("q_reply_parse", """
SELECT doc_id, CAST(pos AS INTEGER) AS pos, item FROM (
  SELECT doc_id, 0 AS pos, text AS item FROM documents WHERE doc_id % 6 <> 5
  UNION ALL SELECT doc_id, 1, 'x' || doc_id FROM documents WHERE doc_id % 6 <> 5
  UNION ALL SELECT doc_id, p, v FROM documents,
    (VALUES (1, 'True'), (2, 'None'), (3, '1.5'), (4, '1e+20'), (5, '1.0'),
            (6, '12345678.0'), (7, '0.0001')) s(p, v)
    WHERE doc_id % 6 = 5
  UNION ALL SELECT doc_id, 0, CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 6 = 5
  UNION ALL SELECT doc_id, 8, text FROM documents WHERE doc_id % 6 = 5
)
""")
def q_reply_parse(spark, sf_dir):
    """Fences, preamble, trailing text with brackets, scalars rendered with
    Python ``str``."""
    from ..operators import replies
    parsed = replies.parse_replies(_doc_replies(spark, sf_dir), "reply", "n")
    return replies.explode_items(parsed, keep=("doc_id",)).select(
        "doc_id", "pos", F.col("translated_text").alias("item"))


@register("q_reply_status", """
SELECT doc_id,
       CASE doc_id % 6 WHEN 0 THEN 'wrong_count' WHEN 1 THEN 'not_array'
            WHEN 2 THEN 'invalid_json' WHEN 3 THEN 'nested_item' WHEN 4 THEN 'truncated'
            ELSE 'ok' END AS status,
       CAST(CASE WHEN doc_id % 6 = 5 THEN 2 END AS INTEGER) AS n_items
FROM documents
""")
def q_reply_status(spark, sf_dir):
    """Provider envelope (truncation) and validation outcomes."""
    from ..operators import replies
    d = tables.read_table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    k = F.col("doc_id") % 6
    t = F.to_json(F.array("text"))
    body = (F.when(k == 0, t)
             .when(k == 1, F.concat(F.lit('{"key": '), t.substr(F.lit(2), F.length(t) - 2), F.lit("}")))
             .when(k == 2, F.concat(F.lit("not json at all "), F.col("doc_id").cast("string")))
             .when(k == 3, F.concat(F.lit('[{"t": '), t.substr(F.lit(2), F.length(t) - 2),
                                    F.lit('}, "w"]')))
             .otherwise(F.to_json(F.array(F.col("text"), F.lit("w")))))
    stop = F.when(k == 4, F.lit("max_tokens")).otherwise(F.lit("end_turn"))
    env = F.to_json(F.struct(
        F.array(F.struct(F.lit("text").alias("type"), body.alias("text"))).alias("content"),
        stop.alias("stop_reason")))
    e = d.select("doc_id", env.alias("raw"), F.lit(2).alias("n"))
    text, status = replies.envelope_text("anthropic", "raw")
    e = e.select("doc_id", "n", text.alias("reply"), status.alias("status"))
    parsed = replies.parse_replies(e, "reply", "n")
    return parsed.select("doc_id", "status", F.size("items").cast("int").alias("n_items")
                         ).withColumn("n_items", F.when(F.col("status") == "ok", F.col("n_items")))


# --- M5: inference ------------------------------------------------------------------

RECORD_COLS = ("batch_id", "pos", "variant_idx", "filepath", "string_key", "string_id",
               "field", "source_text", "translated_text")

RECORDS_SQL = O.with_(*O.BASE, O.UNITS, O.NUMBERED) + f""",
recs AS (
  SELECT CAST(idx // {BATCH_SIZE} AS BIGINT) AS batch_id, CAST(idx % {BATCH_SIZE} AS INTEGER) AS pos,
         CAST(variant_idx AS INTEGER) AS variant_idx, filepath, string_key, string_id, field,
         source_text, '[xx] ' || source_text AS translated_text
  FROM numbered
  UNION ALL
  SELECT CAST(idx // {BATCH_SIZE} AS BIGINT), CAST(idx % {BATCH_SIZE} AS INTEGER), 1, filepath,
         string_key, string_id, 'maleVariant', source_text, '[xx] ' || source_text
  FROM numbered WHERE is_dedup
)
"""


def _translate(spark, sf_dir, fn_factory, stop_on_failure=False):
    from . import pipeline
    entries = fixture_entries(spark, sf_dir)
    return pipeline.translate(entries, fixture_log(entries), fn_factory, "English", "Kazakh",
                              batch_size=BATCH_SIZE, run_id="r1", backoff_base=0,
                              stop_on_failure=stop_on_failure)


@register("q_translate_fake", RECORDS_SQL + "SELECT * FROM recs")
def q_translate_fake(spark, sf_dir):
    """The whole translation step with a deterministic translator:
    resume, dedup, batches, prompts, calls, parse, zip, dedup expansion."""
    from . import pipeline
    t = _translate(spark, sf_dir, pipeline.echo_translator())
    return t.records.select(*RECORD_COLS)


@register("q_stop_rule", RECORDS_SQL + "SELECT * FROM recs WHERE batch_id < 3")
def q_stop_rule(spark, sf_dir):
    """Batches with id % 7 = 3 fail all three attempts; parity mode keeps only
    the batches before the first failure."""
    from . import pipeline
    fails = pipeline.failing_translator(lambda r: r["batch_id"] % 7 == 3)
    t = _translate(spark, sf_dir, fails, stop_on_failure=True)
    return t.records.select(*RECORD_COLS)


@register("q_retry", O.with_(*O.BASE, O.UNITS, O.NUMBERED) + f"""
SELECT DISTINCT CAST(idx // {BATCH_SIZE} AS BIGINT) AS batch_id,
       CASE WHEN (idx // {BATCH_SIZE}) % 9 = 4 THEN 3
            WHEN (idx // {BATCH_SIZE}) % 4 = 1 THEN 2 ELSE 1 END AS attempts,
       CASE WHEN (idx // {BATCH_SIZE}) % 9 = 4 THEN 'error' ELSE 'ok' END AS status
FROM numbered
""")
def q_retry(spark, sf_dir):
    """Batches with id % 4 = 1 fail their first attempt and succeed on the second;
    batches with id % 9 = 4 fail every attempt and end as 'error'."""
    from . import pipeline

    def fails(r):
        if r["batch_id"] % 9 == 4:
            return True
        return r["batch_id"] % 4 == 1 and r["attempt"] == 1
    t = _translate(spark, sf_dir, pipeline.failing_translator(fails))
    return t.results.select("batch_id", F.col("attempts").cast("int").alias("attempts"), "status")


# --- M2: log, last wins, apply --------------------------------------------------------

def fixture_logs(entries: DataFrame) -> DataFrame:
    """Two runs: r1 translates every 5th female variant; r2 re-translates every 10th
    and adds every entry with entry_idx % 10 = 3.  Order within a run = entry order."""
    e = entries

    def run(df, run_id, prefix):
        return df.select(F.lit(run_id).alias("run_id"), F.col("entry_idx").cast("long").alias("batch_id"),
                         F.lit(0).alias("pos"), "variant_idx", "filepath", "string_key",
                         "string_id", "field", "source_text",
                         F.concat(F.lit(prefix), F.col("source_text")).alias("translated_text"),
                         F.lit("translated").alias("status"))
    r1 = run(e.filter((e.entry_idx % 5 == 0) & (e.variant_idx == 0)), "r1", "[xx] ")
    r2 = run(e.filter(((e.entry_idx % 10 == 0) & (e.variant_idx == 0)) | (e.entry_idx % 10 == 3)),
             "r2", "[yy] ")
    return records.union_logs(r1, r2)


LOGS_SQL = """,
logs AS (
  SELECT 'r1' AS run_id, entry_idx, variant_idx, filepath, string_key, string_id, field,
         source_text, '[xx] ' || source_text AS translated_text
  FROM entries WHERE entry_idx % 5 = 0 AND variant_idx = 0
  UNION ALL
  SELECT 'r2', entry_idx, variant_idx, filepath, string_key, string_id, field, source_text,
         '[yy] ' || source_text
  FROM entries WHERE (entry_idx % 10 = 0 AND variant_idx = 0) OR entry_idx % 10 = 3
), latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY filepath, string_key, string_id, field
                                 ORDER BY run_id DESC, entry_idx DESC, variant_idx DESC) AS rn
    FROM logs) WHERE rn = 1
), patched AS (
  SELECT e.filepath, e.entry_idx, e.variant_idx, e.field, e.string_key, e.string_id,
         coalesce(l.translated_text, e.source_text) AS translated_text,
         l.translated_text IS NOT NULL AS matched
  FROM entries e LEFT JOIN latest l
    ON e.filepath = l.filepath AND e.string_key = l.string_key
   AND e.string_id IS NOT DISTINCT FROM l.string_id AND e.field = l.field
)
"""


def _logs_query(sql: str) -> str:
    return "WITH " + O.RAW_ENTRIES + "," + O.ENTRIES + LOGS_SQL + sql


@register("q_last_wins", _logs_query("""
SELECT filepath, string_key, string_id, field, translated_text FROM latest
"""))
def q_last_wins(spark, sf_dir):
    """Union of two runs; per entry key the last record in log order wins."""
    logs = fixture_logs(fixture_entries(spark, sf_dir))
    return records.latest_per_key(logs).select("filepath", "string_key", "string_id", "field",
                                               "translated_text")


@register("q_apply", _logs_query("""
SELECT filepath, entry_idx, variant_idx, field, translated_text, matched FROM patched
"""))
def q_apply(spark, sf_dir):
    """Every entry with its translation (source kept when there is none)."""
    from ..operators import apply as ap
    entries = fixture_entries(spark, sf_dir)
    patched = ap.apply_log(entries, fixture_logs(entries))
    return patched.select("filepath", "entry_idx", "variant_idx", "field", "translated_text",
                          "matched")


@register("q_apply_counts", _logs_query("""
SELECT CAST(count(*) FILTER (WHERE matched) AS BIGINT) AS n_updated,
       CAST(count(DISTINCT filepath) FILTER (WHERE matched) AS BIGINT) AS n_files_modified
FROM patched
"""))
def q_apply_counts(spark, sf_dir):
    """Strings updated (each matched occurrence) and files modified."""
    from ..operators import apply as ap
    entries = fixture_entries(spark, sf_dir)
    return ap.apply_counts(ap.apply_log(entries, fixture_logs(entries)))


@register("q_touched_files", _logs_query("""
SELECT DISTINCT filepath FROM raw_entries WHERE filepath IN (SELECT filepath FROM logs)
"""))
def q_touched_files(spark, sf_dir):
    """Documents named by the log (semi join on normalized paths)."""
    from ..operators import apply as ap
    docs = tables.read_table(spark, sf_dir, "documents")
    files = tables.raw_entries(docs).select("filepath").distinct()
    logs = fixture_logs(extract.unpivot_variants(tables.raw_entries(docs)))
    return ap.touched_documents(files, logs)


@register("q_stale", "WITH " + O.RAW_ENTRIES + "," + O.ENTRIES + """,
old AS (
  SELECT filepath, string_key, string_id, field, entry_idx, variant_idx,
         CASE WHEN entry_idx % 8 = 0 THEN 'old: ' || source_text ELSE source_text END AS source_text
  FROM entries WHERE entry_idx % 4 = 0 AND variant_idx = 0
), latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY filepath, string_key, string_id, field
                                 ORDER BY entry_idx DESC) AS rn FROM old) WHERE rn = 1
)
SELECT e.filepath, e.entry_idx, e.variant_idx, e.field, l.source_text <> e.source_text AS stale
FROM entries e JOIN latest l
  ON e.filepath = l.filepath AND e.string_key = l.string_key
 AND e.string_id IS NOT DISTINCT FROM l.string_id AND e.field = l.field
""")
def q_stale(spark, sf_dir):
    """Entries whose latest log record was translated from another source text."""
    from ..operators import qa
    entries = fixture_entries(spark, sf_dir)
    e = entries.filter((F.col("entry_idx") % 4 == 0) & (F.col("variant_idx") == 0))
    old = e.select(F.lit("r0").alias("run_id"), F.col("entry_idx").cast("long").alias("batch_id"),
                   F.lit(0).alias("pos"), "variant_idx", "filepath", "string_key", "string_id",
                   "field",
                   F.when(F.col("entry_idx") % 8 == 0, F.concat(F.lit("old: "), F.col("source_text")))
                    .otherwise(F.col("source_text")).alias("source_text"),
                   F.lit("t").alias("translated_text"))
    return qa.stale_translations(entries, old).select("filepath", "entry_idx", "variant_idx",
                                                      "field", "stale")


# --- M6: documents --------------------------------------------------------------------

JSON_DOCS_SQL = """
WITH d AS (
  SELECT doc_id, text,
         'loc/' || lang || '-' || lang || '/' || source || '/' || doc_id || '.json.json' AS filepath,
         CAST(CASE WHEN doc_id % 4 = 2 THEN 2 ELSE 0 END AS INTEGER) AS entry_idx,
         CASE doc_id % 5 WHEN 0 THEN 'sk' || doc_id WHEN 1 THEN 'None'
              WHEN 2 THEN 'type' || (doc_id % 3) WHEN 3 THEN 'unknown' ELSE 'False' END AS string_key,
         CASE (doc_id // 5) % 5 WHEN 0 THEN CAST(doc_id AS VARCHAR) WHEN 3 THEN 's' || doc_id
              WHEN 4 THEN doc_id || '.5' END AS string_id
  FROM documents WHERE doc_id % 50 NOT IN (7, 17)
), x AS (
  SELECT doc_id, filepath, entry_idx, 0 AS variant_idx, 'femaleVariant' AS field, string_key,
         string_id, text AS source_text FROM d
  UNION ALL SELECT doc_id, filepath, entry_idx, 1, 'maleVariant', string_key, string_id, text
  FROM d WHERE doc_id % 6 = 0
  UNION ALL SELECT doc_id, filepath, entry_idx, 1, 'maleVariant', string_key, string_id,
                   text || ' (m)' FROM d WHERE doc_id % 6 = 5
)
"""


def json_docs(spark, sf_dir) -> DataFrame:
    # building and parsing JSON text is heavy per row: spread a single-split scan
    return tables.json_documents(tables.read_table(spark, sf_dir, "documents", spread=True))


@register("q_extract_json", JSON_DOCS_SQL + """
SELECT filepath, entry_idx, variant_idx, field, string_key, string_id, source_text FROM x
""")
def q_extract_json(spark, sf_dir):
    """JSON documents of four shapes -> entries; bad files skipped."""
    return extract.extract_entries(json_docs(spark, sf_dir))


@register("q_key_fallback", JSON_DOCS_SQL + """
SELECT filepath, entry_idx, string_key, string_id FROM x WHERE field = 'femaleVariant'
""")
def q_key_fallback(spark, sf_dir):
    """key = secondaryKey if present (null -> 'None', false -> 'False'),
    else $type, else 'unknown'; id stringified like Python, NULL when missing or null."""
    e = extract.extract_entries(json_docs(spark, sf_dir))
    return e.filter(F.col("field") == "femaleVariant").select(
        "filepath", "entry_idx", "string_key", "string_id")


@register("q_quarantine", """
SELECT 'loc/' || lang || '-' || lang || '/' || source || '/' || doc_id || '.json.json' AS filepath,
       'extract' AS stage, 'invalid_json' AS reason
FROM documents WHERE doc_id % 50 IN (7, 17)
""")
def q_quarantine(spark, sf_dir):
    """Unreadable documents (truncated, trailing junk) go to quarantine."""
    return extract.quarantine(extract.parse_documents(json_docs(spark, sf_dir)))


@register("q_rebuild_docs", JSON_DOCS_SQL + """
SELECT filepath, entry_idx, variant_idx, field,
       CASE WHEN field = 'femaleVariant' THEN '[xx] ' || source_text ELSE source_text END
         AS source_text
FROM x WHERE doc_id % 3 = 0
""")
def q_rebuild_docs(spark, sf_dir):
    """Rewrite the documents named by the log (female variants of every
    3rd document translated), then extract the rewritten documents again."""
    from ..operators import apply as ap
    docs = json_docs(spark, sf_dir)
    entries = extract.extract_entries(docs)
    doc_id = F.regexp_extract("filepath", r"/(\d+)\.json\.json$", 1).cast("long")
    log = (entries.filter((F.col("field") == "femaleVariant") & (doc_id % 3 == 0))
                  .select("filepath", "string_key", "string_id", "field", "source_text",
                          F.concat(F.lit("[xx] "), F.col("source_text")).alias("translated_text"),
                          F.lit("r1").alias("run_id"), F.lit(0).cast("long").alias("batch_id"),
                          F.lit(0).alias("pos"), "variant_idx"))
    patched = ap.apply_log(entries, log)
    rebuilt = ap.rebuild_documents(ap.touched_documents(docs.drop("doc_id"), log), patched)
    return extract.extract_entries(rebuilt).select("filepath", "entry_idx", "variant_idx",
                                                   "field", "source_text")


@register("q_json_props", """
SELECT event_id, CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS BIGINT) AS k FROM events
""")
def q_json_props(spark, sf_dir):
    """A field read out of a JSON text column through VARIANT."""
    ev = tables.read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
                     .alias("k"))


# --- M7: paths, selection, limits, gates ----------------------------------------------

LOCALE = "en-en"


def _built_paths(spark, sf_dir) -> DataFrame:
    d = tables.read_table(spark, sf_dir, "documents")
    k4, k3 = d.doc_id % 4, d.doc_id % 3
    loc = (F.when(k4 == 0, F.concat(d.lang, F.lit("-"), d.lang))
            .when(k4 == 1, F.concat(F.upper(d.lang), F.lit("_"), F.upper(d.lang)))
            .when(k4 == 2, F.concat(d.lang, F.lit("-xx")))
            .otherwise(F.concat(F.lit("voice_"), d.lang)))
    ext = F.when(k3 == 0, F.lit(".json")).otherwise(F.lit(".json.json"))
    return d.select("doc_id", F.concat(d.source, F.lit("/"), loc, F.lit("/f"),
                                       d.doc_id.cast("string"), ext).alias("path"))


@register("q_locale_filter", """
WITH p AS (
  SELECT doc_id, source || '/' || CASE doc_id % 4 WHEN 0 THEN lang || '-' || lang
      WHEN 1 THEN upper(lang) || '_' || upper(lang) WHEN 2 THEN lang || '-xx'
      ELSE 'voice_' || lang END || '/f' || doc_id
      || CASE doc_id % 3 WHEN 0 THEN '.json' ELSE '.json.json' END AS path
  FROM documents
)
SELECT doc_id, path, CASE WHEN ends_with(path, '.json.json') THEN 'converted' ELSE 'raw' END AS kind,
       'en' AS locale_code
FROM p
WHERE list_contains(string_split(lower(path), '/'), 'en-en')
   OR list_contains(string_split(lower(path), '/'), 'en_en')
""")
def q_locale_filter(spark, sf_dir):
    """P1, P11, S1/S2 naming: paths under the locale folder (either separator, any
    case), split into converted (.json.json) and raw (.json) documents."""
    from ..functions.paths import is_locale_path, locale_code
    p = _built_paths(spark, sf_dir).filter(is_locale_path(F.col("path"), LOCALE))
    return p.select("doc_id", "path",
                    F.when(F.col("path").endswith(".json.json"), F.lit("converted"))
                     .otherwise(F.lit("raw")).alias("kind"),
                    locale_code(F.lit(LOCALE)).alias("locale_code"))


SOURCE_CODE = "es"


def _listing(spark, sf_dir) -> DataFrame:
    d = tables.read_table(spark, sf_dir, "documents")
    k = d.doc_id % 5
    name = (F.when(k == 0, F.concat(F.lit("lang_"), d.lang, F.lit("_text.archive")))
             .when(k == 1, F.concat(F.lit("lang_"), d.lang, F.lit("_voice.archive")))
             .when(k == 2, F.concat(F.lit("xlang_"), d.lang, F.lit("_extra"),
                                    (d.doc_id % 3).cast("string"), F.lit(".archive")))
             .when(k == 3, F.concat(F.lit("other_"), d.doc_id.cast("string"), F.lit(".archive")))
             .otherwise(F.concat(F.lit("lang_"), d.lang, F.lit("_text_patch.archive"))))
    return d.select(F.concat(F.lit("archive/pc/"), d.source).alias("dir"), name.alias("name")).distinct()


@register("q_source_fallback", f"""
WITH l AS (
  SELECT DISTINCT 'archive/pc/' || source AS dir,
         CASE doc_id % 5 WHEN 0 THEN 'lang_' || lang || '_text.archive'
              WHEN 1 THEN 'lang_' || lang || '_voice.archive'
              WHEN 2 THEN 'xlang_' || lang || '_extra' || (doc_id % 3) || '.archive'
              WHEN 3 THEN 'other_' || doc_id || '.archive'
              ELSE 'lang_' || lang || '_text_patch.archive' END AS name
  FROM documents
), c AS (
  SELECT *, name = 'lang_{SOURCE_CODE}_text.archive' AS is_primary FROM l
  WHERE name = 'lang_{SOURCE_CODE}_text.archive'
     OR (name LIKE '%lang\\_{SOURCE_CODE}%.archive' ESCAPE '\\' AND NOT contains(lower(name), 'voice'))
)
SELECT dir, name FROM c
WHERE is_primary = (SELECT max(CAST(is_primary AS INT)) = 1 FROM c c2 WHERE c2.dir = c.dir)
""")
def q_source_fallback(spark, sf_dir):
    """Per folder the primary text archive, else the fallback glob without
    voice archives."""
    from ..operators import selection
    return selection.select_sources(_listing(spark, sf_dir), SOURCE_CODE)


LIMIT = 25


@register("q_limit", JSON_DOCS_SQL + f""",
files AS (
  SELECT 'loc/' || lang || '-' || lang || '/' || source || '/' || doc_id || '.json.json' AS filepath
  FROM documents ORDER BY string_split(filepath, '/') LIMIT {LIMIT}
)
SELECT filepath, entry_idx, variant_idx, field, source_text FROM x
WHERE filepath IN (SELECT filepath FROM files)
ORDER BY string_split(filepath, '/'), entry_idx, variant_idx LIMIT {LIMIT}
""")
def q_limit(spark, sf_dir):
    """First N files of the listing in path-component order, unreadable
    ones included, then first N entries of those files (the limit is the feature)."""
    from ..operators import selection
    docs = selection.limit_documents(json_docs(spark, sf_dir), LIMIT)
    e = selection.limit_entries(extract.extract_entries(docs), LIMIT)
    return e.select("filepath", "entry_idx", "variant_idx", "field", "source_text")


MOD_NAME = "LocalizationMod"


@register("q_manifest", f"""
SELECT name, 'archive/pc/mod/{MOD_NAME}'
       || CASE WHEN i > 0 THEN '_' || i ELSE '' END || '.archive' AS package_path
FROM (SELECT name, row_number() OVER (ORDER BY name) - 1 AS i
      FROM (SELECT DISTINCT source || '.archive' AS name FROM documents))
""")
def q_manifest(spark, sf_dir):
    """K6: package names for the output archives in name order (distributed index)."""
    from ..operators import selection
    d = tables.read_table(spark, sf_dir, "documents")
    return selection.manifest(d.select(F.concat("source", F.lit(".archive")).alias("name")),
                              MOD_NAME)


@register("q_preview", O.with_(O.RAW_ENTRIES, O.ENTRIES) + f"""
SELECT filepath, CAST(count(*) AS BIGINT) AS n_strings,
       CAST(sum(length(source_text)) AS BIGINT) AS n_chars,
       CAST(ceil(count(*) / {BATCH_SIZE}) AS BIGINT) AS n_batches
FROM entries GROUP BY ROLLUP (filepath)
""")
def q_preview(spark, sf_dir):
    """Cost preview per file with a grand total."""
    from ..operators import qa
    return qa.cost_preview(fixture_entries(spark, sf_dir), BATCH_SIZE)


@register("q_failure_gate", """
WITH o AS (
  SELECT lang, CASE WHEN lang = 'de' THEN doc_id % 5 <> 0 ELSE doc_id % 13 <> 0 END AS ok
  FROM documents
), g AS (
  SELECT lang, count(*) AS total, count(*) FILTER (WHERE NOT ok) AS failed FROM o GROUP BY lang
)
SELECT lang, CAST(total AS BIGINT) AS total, CAST(failed AS BIGINT) AS failed,
       CAST(failed AS DOUBLE) * 100 / total AS pct,
       CAST(failed AS DOUBLE) * 100 / total > 10 AS too_high, failed = total AS all_failed
FROM g
""")
def q_failure_gate(spark, sf_dir):
    """Conversion outcomes per language; failure rate above 10 % trips
    the gate (exactly 10 % passes)."""
    from ..operators import gates
    d = tables.read_table(spark, sf_dir, "documents")
    ok = F.when(d.lang == "de", d.doc_id % 5 != 0).otherwise(d.doc_id % 13 != 0)
    return gates.failure_rates(d.select("lang", ok.alias("ok")), "ok", ["lang"]).select(
        "lang", "total", "failed", "pct", "too_high", "all_failed")


# --- M8: QA extensions, CSV ---------------------------------------------------------

@register("q_markup_check", r"""
WITH t AS (SELECT page_id, html AS s, replace(html, '</p>', '') AS t FROM pages)
SELECT page_id,
       CAST(len(regexp_extract_all(s, '<[^<>]+>')) AS INTEGER) AS n_src_tags,
       CAST(len(regexp_extract_all(t, '<[^<>]+>')) AS INTEGER) AS n_tgt_tags,
       list_sort(regexp_extract_all(s, '<[^<>]+>')) = list_sort(regexp_extract_all(t, '<[^<>]+>'))
         AS tags_ok,
       list_sort(regexp_extract_all(s, '\{[A-Za-z_][A-Za-z0-9_]*\}'))
         = list_sort(regexp_extract_all(t, '\{[A-Za-z_][A-Za-z0-9_]*\}')) AS placeholders_ok
FROM t
""")
def q_markup_check(spark, sf_dir):
    """Tags and placeholders of each page against a copy with '</p>' removed."""
    from ..operators import qa
    p = tables.read_table(spark, sf_dir, "pages")
    t = p.select("page_id", F.col("html").alias("source_text"),
                 F.replace(F.col("html"), F.lit("</p>"), F.lit("")).alias("translated_text"))
    return qa.markup_report(t).select("page_id", "n_src_tags", "n_tgt_tags", "tags_ok",
                                      "placeholders_ok")


@register("q_len_ratio", """
SELECT u.conv_id, u.turn,
       CAST(length(a.text) AS DOUBLE) / length(u.text) AS ratio,
       CAST(length(a.text) AS DOUBLE) / length(u.text) > 1.5 AS too_long
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'
""")
def q_len_ratio(spark, sf_dir):
    """Each user turn against the assistant turn that follows it."""
    from ..operators import qa
    c = tables.read_table(spark, sf_dir, "conversations")
    u = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("source_text"))
    a = c.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("translated_text"))
    return qa.length_ratio(u.join(a, ["conv_id", "turn"])).select(
        "conv_id", "turn", "ratio", "too_long")


@register("q_csv_roundtrip", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG) + """
SELECT filepath, string_key, string_id, field, source_text, translated_text FROM log
""")
def q_csv_roundtrip(spark, sf_dir):
    """The log written as CSV (quotes, commas, newlines, NULL ids) and
    read back."""
    from ..session import scratch_path
    from ..sinks.files import write_log_csv
    from ..sources.logs import read_log_csv
    log = fixture_log(fixture_entries(spark, sf_dir))
    path = scratch_path(spark, "log-csv")
    write_log_csv(log.withColumn("run_id", F.lit("r1")).withColumn(
        "batch_id", F.col("entry_idx").cast("long")).withColumn("pos", F.lit(0)), path)
    back = read_log_csv(spark, path)
    return back.select("filepath", "string_key", "string_id", "field", "source_text",
                       "translated_text")


# --- streaming ------------------------------------------------------------------------

@register("q_stream_log", JSON_DOCS_SQL + """
SELECT filepath, string_key, string_id, field, source_text,
       '[xx] ' || source_text AS translated_text
FROM x
""")
def q_stream_log(spark, sf_dir):
    """ST1: documents arrive in two drops; an availableNow stream with a checkpoint
    translates each new micro-batch and appends to the log.  The second run sees only
    the second drop; the log holds every entry exactly once."""
    from ..session import scratch_path
    from ..streaming.incremental import run_incremental
    from . import pipeline
    docs = json_docs(spark, sf_dir)
    src = scratch_path(spark, "stream-src")
    log_path = scratch_path(spark, "stream-log")
    ckpt = scratch_path(spark, "stream-ckpt")
    for part in (0, 1):
        docs.filter(F.col("doc_id") % 2 == part).select("filepath", "content") \
            .write.mode("append").parquet(src)
        run_incremental(spark, src, log_path, ckpt, pipeline.echo_translator(), "English",
                        "Kazakh", source="parquet", backoff_base=0)
    return spark.read.parquet(log_path).select(
        "filepath", "string_key", "string_id", "field", "source_text", "translated_text")


@register("q_locale_dim", """
WITH l(language, locale) AS (VALUES """ + ", ".join(
    "(" + _sql_text(a) + ", " + _sql_text(b) + ")" for a, b in LOCALES) + """),
d AS (SELECT lang AS code, count(*) AS n_docs, sum(n_chars) AS n_chars FROM documents GROUP BY lang)
SELECT d.code, CAST(d.n_docs AS BIGINT) AS n_docs, CAST(d.n_chars AS BIGINT) AS n_chars,
       l.language, l.locale, 'lang_' || d.code || '_text.archive' AS archive
FROM d LEFT JOIN l ON split_part(l.locale, '-', 1) = d.code
""")
def q_locale_dim(spark, sf_dir):
    """Documents per language joined with the locale dimension (broadcast of
    a fixed 16-row table)."""
    from ..operators import qa
    d = tables.read_table(spark, sf_dir, "documents").groupBy(F.col("lang").alias("code")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").cast("long").alias("n_chars"))
    out = qa.with_locales(d, qa.locale_table(spark))
    return out.select("code", "n_docs", "n_chars", "language", "locale",
                      F.concat(F.lit("lang_"), F.col("code"), F.lit("_text.archive")).alias("archive"))


@register("q_extract_counts", JSON_DOCS_SQL + """
SELECT 'entries' AS metric, CAST(count(*) AS BIGINT) AS value FROM x
UNION ALL SELECT 'files', CAST(count(*) AS BIGINT) FROM documents WHERE doc_id % 50 NOT IN (7, 17)
UNION ALL SELECT 'files_skipped', CAST(count(*) AS BIGINT) FROM documents WHERE doc_id % 50 IN (7, 17)
""")
def q_extract_counts(spark, sf_dir):
    """A4: entries extracted, files read, files skipped (one pass over the documents)."""
    return extract.extraction_metrics(json_docs(spark, sf_dir).select("filepath", "content"))


@register("q_run_counts", _logs_query("""
SELECT CAST(count(*) FILTER (WHERE run_id = 'r2') AS BIGINT) AS n_new,
       CAST(count(*) AS BIGINT) AS n_total
FROM logs
"""))
def q_run_counts(spark, sf_dir):
    """Records of the latest run and records in total."""
    return records.run_counts(fixture_logs(fixture_entries(spark, sf_dir)), "r2")


@register("q_preview_resume", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG, O.PENDING) + """
SELECT filepath, entry_idx, variant_idx, field, 'pending' AS state FROM pending
""")
def q_preview_resume(spark, sf_dir):
    """A preview (blank translations, status 'preview') of every entry is
    added to the log; resume still counts only translated rows as done."""
    entries = fixture_entries(spark, sf_dir)
    log = fixture_log(entries).select(
        F.lit("r1").alias("run_id"), F.col("entry_idx").cast("long").alias("batch_id"),
        F.lit(0).alias("pos"), "variant_idx", "filepath", "string_key", "string_id", "field",
        "source_text", "translated_text", F.lit("translated").alias("status"))
    preview = records.preview_records(entries, "p1")
    both = records.union_logs(log, preview)
    p = resume.pending(entries, both)
    return p.select("filepath", "entry_idx", "variant_idx", "field", F.lit("pending").alias("state"))


@register("q_translate_waves", RECORDS_SQL + "SELECT * FROM recs")
def q_translate_waves(spark, sf_dir):
    """The translation job in three waves, each appended to the log before the
    next starts (a restart resumes from the log); each wave reads only its partition."""
    from ..session import scratch_path
    from . import pipeline
    entries = fixture_entries(spark, sf_dir)
    log_path = scratch_path(spark, "wave-log")
    # the fixture's partial log is the starting point of the job
    records.append_log(fixture_log_table(entries), log_path)
    pipeline.run_translation_job(entries, log_path, pipeline.echo_translator(), "English",
                                 "Kazakh", batch_size=BATCH_SIZE, n_waves=3, run_id="r1",
                                 backoff_base=0)
    return (spark.read.parquet(log_path).filter(F.col("run_id") == "r1")
                 .select(*RECORD_COLS))


@register("q_translate_envelope", O.with_(*O.BASE, O.UNITS, O.NUMBERED) + f"""
SELECT DISTINCT CAST(idx // {BATCH_SIZE} AS BIGINT) AS batch_id,
       CASE WHEN (idx // {BATCH_SIZE}) % 5 = 2 THEN 2 ELSE 1 END AS attempts,
       'ok' AS status
FROM numbered
""")
def q_translate_envelope(spark, sf_dir):
    """R1 + I3: the provider returns message envelopes; batches with id % 5 = 2 are
    cut at the output cap on their first attempt (stop_reason max_tokens), which
    counts as a failed attempt and is retried."""
    import json as _json
    from . import pipeline

    def factory():
        def fn(req):
            truncated = req["batch_id"] % 5 == 2 and req["attempt"] == 1
            text = _json.dumps(["[xx] " + t for t in req["texts"]], ensure_ascii=False)
            return _json.dumps({"content": [{"type": "text", "text": text}],
                                "stop_reason": "max_tokens" if truncated else "end_turn"})
        return fn
    entries = fixture_entries(spark, sf_dir)
    t = pipeline.translate(entries, fixture_log(entries), factory, "English", "Kazakh",
                           batch_size=BATCH_SIZE, run_id="r1", backoff_base=0,
                           envelope="anthropic")
    return t.results.select("batch_id", F.col("attempts").cast("int").alias("attempts"), "status")


# --- order of imported logs, failures and their retry ---------------------------------------

@register("q_csv_last_wins", _logs_query("""
, runs AS (
  SELECT CASE run_id WHEN 'r1' THEN 1 ELSE 2 END AS rk, entry_idx, filepath, string_key, string_id,
         field, translated_text FROM logs
  UNION ALL
  SELECT 3, entry_idx, filepath, string_key, string_id, field, '[zz] ' || source_text
  FROM entries WHERE entry_idx % 20 = 0 AND variant_idx = 0
)
SELECT filepath, string_key, string_id, field,
       arg_max(translated_text, CAST(rk AS BIGINT) * 1000000000 + entry_idx) AS translated_text
FROM runs GROUP BY filepath, string_key, string_id, field
"""))
def q_csv_last_wins(spark, sf_dir):
    """Two runs exported to CSV part files and imported, then a third run; per
    key the last record of the latest run wins."""
    from ..session import scratch_path
    from ..sinks.files import write_log_csv
    from ..sources.logs import read_log_csv
    entries = fixture_entries(spark, sf_dir)
    path = scratch_path(spark, "log-csv")
    write_log_csv(fixture_logs(entries), path)
    third = entries.filter("entry_idx % 20 = 0 and variant_idx = 0").select(
        F.lit("r3").alias("run_id"), F.col("entry_idx").cast("long").alias("batch_id"),
        F.lit(0).alias("pos"), "variant_idx", "filepath", "string_key", "string_id", "field",
        "source_text", F.concat(F.lit("[zz] "), "source_text").alias("translated_text"),
        F.lit("translated").alias("status"))
    log = records.union_logs(read_log_csv(spark, path), third)
    return records.latest_per_key(log).select("filepath", "string_key", "string_id", "field",
                                              "translated_text")


@register("q_failures", O.with_(*O.BASE, O.UNITS, O.NUMBERED) + f"""
SELECT CAST(idx // {BATCH_SIZE} AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS n,
       3 AS attempts, 'error' AS status,
       'RuntimeError: provider error for batch ' || (idx // {BATCH_SIZE}) AS error
FROM numbered GROUP BY idx // {BATCH_SIZE} HAVING (idx // {BATCH_SIZE}) % 5 = 2
""")
def q_failures(spark, sf_dir):
    """The job's table of failed batches, with whole error texts."""
    from ..session import scratch_path
    from . import pipeline
    entries = fixture_entries(spark, sf_dir)
    log_path = scratch_path(spark, "failing-log")
    records.append_log(fixture_log_table(entries), log_path)
    pipeline.run_translation_job(entries, log_path, pipeline.failing_translator(
        lambda r: r["batch_id"] % 5 == 2), "English", "Kazakh", batch_size=BATCH_SIZE, run_id="r1",
        backoff_base=0)
    return spark.read.parquet(pipeline.failures_path(log_path)).select(
        "batch_id", F.col("n").cast("int").alias("n"), F.col("attempts").cast("int").alias("attempts"),
        "status", "error")


@register("q_stream_retry", JSON_DOCS_SQL + """
SELECT filepath, string_key, string_id, field, source_text,
       '[xx] ' || source_text AS translated_text
FROM x
""")
def q_stream_retry(spark, sf_dir):
    """ST1: the provider fails for half of the first start's batches; the second start finds
    no new file and translates what was left.  The log holds every entry exactly once."""
    from ..session import scratch_path
    from ..streaming.incremental import run_incremental
    from . import pipeline
    src, log_path, ckpt = (scratch_path(spark, f"retry-{x}") for x in ("src", "log", "ckpt"))
    json_docs(spark, sf_dir).select("filepath", "content").write.parquet(src)
    for translator in (pipeline.failing_translator(lambda r: r["batch_id"] % 2 == 0),
                       pipeline.echo_translator()):
        run_incremental(spark, src, log_path, ckpt, translator, "English", "Kazakh",
                        source="parquet", backoff_base=0)
    return spark.read.parquet(log_path).select(
        "filepath", "string_key", "string_id", "field", "source_text", "translated_text")


@register("q_conversion_outcomes", """
SELECT 'loc/' || lang || '/' || doc_id || '.json' AS filepath, doc_id % 9 <> 4 AS ok FROM documents
""")
def q_conversion_outcomes(spark, sf_dir):
    """Raw files left-joined with converted files; a missing output is a failure."""
    from ..operators import gates
    d = tables.read_table(spark, sf_dir, "documents").select("doc_id", F.concat(
        F.lit("loc/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".json")).alias("filepath"))
    converted = d.filter("doc_id % 9 <> 4").select(F.concat("filepath", F.lit(".json")).alias("filepath"))
    return gates.conversion_outcomes(d, converted)


@register("q_output_count", """
SELECT 'archives' AS metric, CAST(count(DISTINCT source) AS BIGINT) AS value FROM documents
""")
def q_output_count(spark, sf_dir):
    """Number of output archives as a metric row."""
    from ..operators import gates
    d = tables.read_table(spark, sf_dir, "documents")
    return gates.output_count(d.select("source").filter("source is not null").distinct(), "archives")


@register("q_model_settings", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN
         CASE doc_id % 3 WHEN 0 THEN 'claude-sonnet-4-20250514' WHEN 1 THEN 'claude-x' ELSE 'own' END
       ELSE CASE doc_id % 3 WHEN 1 THEN 'gpt-4o' WHEN 0 THEN 'o1-mini' ELSE 'own' END END AS model,
       CASE WHEN doc_id % 4 = 0 THEN 7 WHEN doc_id % 4 = 1 THEN 20 ELSE 40 END AS batch_size
FROM documents
""")
def q_model_settings(spark, sf_dir):
    """A model of the other provider is replaced; the first set value wins."""
    from ..functions.models import first_set, resolve_model
    d = tables.read_table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    provider = F.when(i % 2 == 0, "anthropic").otherwise("openai")
    model = F.when(i % 3 == 0, "o1-mini").when(i % 3 == 1, "claude-x").otherwise("own")
    cli = F.when(i % 4 == 0, 7).when(i % 4 == 2, 0)
    config = F.when(i % 4 == 1, 20)
    return d.select("doc_id", resolve_model(provider, model).alias("model"),
                    first_set(cli, config, F.lit(40)).cast("int").alias("batch_size"))


from . import log_queries  # noqa: E402, F401 - registers its queries
