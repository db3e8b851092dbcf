"""Registered queries of the log's storage, the stop rule, CSV byte ranges and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import apply as ap
from ..operators import extract, infer, requests
from ..session import TEXT_CODEC, scratch_path
from ..sinks.bucketed_log import BucketedLog
from . import oracles as O
from . import pipeline
from .queries import (BATCH_SIZE, JSON_DOCS_SQL, RECORDS_SQL, _conv_prompt_sql, conversation_units, fixture_entries,
                      fixture_log, fixture_log_table, json_docs, register)


@register("q_bucketed_resume", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG, O.PENDING) + """
SELECT filepath, entry_idx, variant_idx, field, string_key, string_id FROM pending
""")
def q_bucketed_resume(spark, sf_dir):
    """The log arrives in three appends, of which two are folded into a
    snapshot; resume reads snapshot and delta by path bucket."""
    entries = fixture_entries(spark, sf_dir)
    rows = fixture_log_table(entries)
    log = BucketedLog(spark, scratch_path(spark, "bucketed-log"), n_buckets=64)
    for part in range(3):
        log.append(rows.filter(F.pmod(F.xxhash64("source_text"), F.lit(3)) == part))
        if part == 1:
            log.compact()
    return log.pending(entries).select("filepath", "entry_idx", "variant_idx", "field", "string_key", "string_id")


@register("q_bucketed_job", RECORDS_SQL + """
SELECT variant_idx, filepath, string_key, string_id, field, source_text, translated_text FROM recs
""")
def q_bucketed_job(spark, sf_dir):
    """A job on a bucketed log whose provider fails for some batches, then a
    second run that translates what is pending; the log has every string once."""
    entries = fixture_entries(spark, sf_dir)
    path = scratch_path(spark, "bucketed-job")
    BucketedLog(spark, path, n_buckets=64).append(fixture_log_table(entries))
    for run, translator in (("r1", pipeline.failing_translator(lambda r: r["batch_id"] % 5 == 2)),
                            ("r2", pipeline.echo_translator())):
        pipeline.run_translation_job(entries, path, translator, "English", "Kazakh", batch_size=BATCH_SIZE,
                                     run_id=run, max_attempts=1, backoff_base=0)
    return BucketedLog(spark, path).read().filter(F.col("run_id") != "r0").select(
        "variant_idx", "filepath", "string_key", "string_id", "field", "source_text", "translated_text")


@register("q_frontier_stop", _conv_prompt_sql() + """
SELECT batch_id, CASE WHEN batch_id < 2 THEN 0 WHEN batch_id < 6 THEN 1 END AS slice,
       CASE WHEN batch_id = 4 THEN 3 WHEN batch_id < 6 THEN 1 ELSE 0 END AS calls,
       batch_id < 4 AS kept
FROM p
""")
def q_frontier_stop(spark, sf_dir):
    """I4: calls made per batch when batches with id % 7 = 4 fail all attempts.  Two tasks
    start with a slice of two batches; the next has four and the first lasting failure,
    so nothing beyond batch 5 is called."""
    units = conversation_units(spark, sf_dir)
    reqs = requests.build_requests(units, "English", "Kazakh", "anthropic", "m")
    called = infer.run_frontier(reqs, pipeline.failing_translator(lambda r: r["batch_id"] % 7 == 4),
                                backoff_base=0, parallelism=2)
    kept = infer.stop_at_first_failure(called).select("batch_id", F.lit(True).alias("kept"))
    every = units.select("batch_id").distinct()
    return (every.join(called.select("batch_id", "slice", "attempts"), "batch_id", "left")
                 .join(kept, "batch_id", "left")
                 .select("batch_id", F.col("slice").cast("int").alias("slice"),
                         F.coalesce(F.col("attempts").cast("int"), F.lit(0)).alias("calls"),
                         F.coalesce("kept", F.lit(False)).alias("kept")))


@register("q_calls_in_flight", _conv_prompt_sql() + """
SELECT provider, p.batch_id, CAST(CASE p.batch_id % 4 WHEN 0 THEN 1 WHEN 3 THEN 3 ELSE 2 END AS INTEGER) AS attempts,
       CASE WHEN p.batch_id % 4 < 3 THEN 'ok' WHEN provider = 'openai' THEN 'refused' ELSE 'invalid_envelope' END AS status,
       CASE WHEN p.batch_id % 4 < 3 THEN chars END AS chars
FROM p, (SELECT unnest(['anthropic', 'openai']) AS provider),
     (SELECT batch_id, CAST(sum(length(text) + 5) AS BIGINT) AS chars FROM b GROUP BY batch_id) c
WHERE c.batch_id = p.batch_id
""")
def q_calls_in_flight(spark, sf_dir):
    """Four calls in flight per task, replies out of order, both providers'
    envelopes.  Batches with id % 4 = 1 raise once (tried again by their task), = 2 are cut
    off once (next round), = 3 raise once and then come without content to the end."""
    import json
    import time

    def factory(provider):
        def make():
            def fn(req):
                kind, attempt = req["batch_id"] % 4, req["attempt"]
                time.sleep(0.002 * (3 - kind))
                if kind in (1, 3) and attempt == 1:
                    raise RuntimeError("overloaded")
                text = None if kind == 3 else json.dumps(["[xx] " + t for t in req["texts"]])
                cut = kind == 2 and attempt == 1
                if provider == "openai":
                    return json.dumps({"choices": [{"message": {"content": text},
                                                    "finish_reason": "length" if cut else "stop"}]})
                return json.dumps({"content": [{"type": "text", "text": text}],
                                   "stop_reason": "max_tokens" if cut else "end_turn"})
            return fn
        return make

    units = conversation_units(spark, sf_dir)
    out = None
    for provider in ("anthropic", "openai"):
        reqs = requests.build_requests(units, "English", "Kazakh", provider, "m")
        done = infer.run_batches(reqs, factory(provider), backoff_base=0, envelope=provider, in_flight=4)
        chars = F.aggregate(F.expr("items"), F.lit(0).cast("long"), lambda a, x: a + F.length(x))
        part = done.select(F.lit(provider).alias("provider"), "batch_id", F.col("attempts").cast("int").alias("attempts"),
                           "status", F.when(F.col("status") == "ok", chars).alias("chars"))
        out = part if out is None else out.unionByName(part)
    return out


@register("q_csv_splits", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG) + """
SELECT filepath, string_key, string_id, field, source_text, translated_text, status,
       row_number() OVER (ORDER BY entry_idx, variant_idx) - 1 AS place
FROM (SELECT *, 'translated' AS status FROM log)
""")
def q_csv_splits(spark, sf_dir):
    """The log as CSV part files with line breaks inside quotes, read by byte ranges;
    every record with its place in the log."""
    from ..operators.batching import global_index
    from ..sinks.files import write_log_csv
    from ..sources.csv_splits import read_log_csv_splits
    path = scratch_path(spark, "log-csv")
    log = fixture_log(fixture_entries(spark, sf_dir))
    write_log_csv(log.withColumn("run_id", F.lit("r1")).withColumn(
        "batch_id", F.col("entry_idx").cast("long")).withColumn("pos", F.lit(0)), path)
    back = read_log_csv_splits(spark, path)
    placed = global_index(back, [F.col("run_id"), F.col("batch_id")], "place")
    return placed.select("filepath", "string_key", "string_id", "field", "source_text", "translated_text",
                         "status", F.col("place").cast("long").alias("place"))


@register("q_published_docs", JSON_DOCS_SQL + """
SELECT filepath, entry_idx, variant_idx, field,
       CASE WHEN field = 'femaleVariant' THEN '[v2] ' || source_text ELSE source_text END AS source_text
FROM x
""")
def q_published_docs(spark, sf_dir):
    """K3, K5: the documents are published, then their translation, and a third version is
    written but not published; readers of the folder see the second, extracted again."""
    from ..sinks import files
    docs = json_docs(spark, sf_dir).drop("doc_id")
    root = scratch_path(spark, "published")
    first = files.write_published(docs, root)
    source = files.read_published(spark, root)
    entries = extract.extract_entries(source)
    log = entries.filter(F.col("field") == "femaleVariant").select(
        "filepath", "string_key", "string_id", "field", "source_text",
        F.concat(F.lit("[v2] "), "source_text").alias("translated_text"), F.lit("r1").alias("run_id"),
        F.lit(0).cast("long").alias("batch_id"), F.lit(0).alias("pos"), "variant_idx")
    files.write_published(ap.rebuild_documents(ap.touched_documents(source, log), ap.apply_log(entries, log)),
                          root, expected=first)
    files.write_documents(source, root)
    return extract.extract_entries(files.read_published(spark, root)).select(
        "filepath", "entry_idx", "variant_idx", "field", "source_text")


@register("q_ratio_percentiles", O.with_(O.RAW_ENTRIES, O.ENTRIES) + """
, r AS (SELECT filepath, (length(source_text) + 5)::DOUBLE / length(source_text) AS ratio FROM entries),
o AS (SELECT *, row_number() OVER (PARTITION BY filepath ORDER BY ratio) AS k,
             count(*) OVER (PARTITION BY filepath) AS n FROM r)
SELECT filepath, CAST(max(n) AS BIGINT) AS n, max(ratio) FILTER (k = ceil(0.5 * n)) AS p50,
       max(ratio) FILTER (k = ceil(0.9 * n)) AS p90, max(ratio) FILTER (k = ceil(0.99 * n)) AS p99
FROM o GROUP BY filepath
""")
def q_ratio_percentiles(spark, sf_dir):
    """Percentiles of the length ratio per file, from quantile sketches kept per run and
    file and merged (exact while a file has at most as many strings as a sketch holds)."""
    from ..operators import qa
    entries = fixture_entries(spark, sf_dir).withColumn("translated_text", F.concat(F.lit("[xx] "), "source_text"))
    entries = entries.withColumn("run_id", F.concat(F.lit("r"), F.col("variant_idx").cast("string")))
    return qa.ratio_percentiles(qa.ratio_sketches(entries))


@register("q_stream_failing_starts", JSON_DOCS_SQL + """
SELECT filepath, string_key, string_id, field, source_text, '[xx] ' || source_text AS translated_text
FROM x
""")
def q_stream_failing_starts(spark, sf_dir):
    """ST1, T4: the provider fails for most batches at the first start and for some at the
    second, where more documents have come; the third translates the rest.  Strings with
    NULL ids wait once each, and the bucketed log holds every string once."""
    from ..streaming.incremental import run_incremental
    src, path, ckpt = (scratch_path(spark, f"starts-{x}") for x in ("src", "log", "ckpt"))
    docs = json_docs(spark, sf_dir)
    for start, failing in enumerate((lambda r: r["batch_id"] % 3 > 0, lambda r: r["batch_id"] % 4 == 1, lambda r: False)):
        if start < 2:
            docs.filter(F.col("doc_id") % 2 == start).select("filepath", "content").write.mode("append") \
                .option("compression", TEXT_CODEC).parquet(src)
        run_incremental(spark, src, path, ckpt, pipeline.failing_translator(failing), "English", "Kazakh",
                        source="parquet", backoff_base=0, log_buckets=64)
    return BucketedLog(spark, path).read().select(
        "filepath", "string_key", "string_id", "field", "source_text", "translated_text")


@register("q_collisions", O.with_(O.RAW_ENTRIES, O.ENTRIES) + """
SELECT filepath, CAST(count(*) AS BIGINT) AS n_keys, CAST(sum(n) AS BIGINT) AS n_entries
FROM (SELECT filepath, string_key, string_id, field, count(*) AS n FROM entries
      GROUP BY filepath, string_key, string_id, field HAVING count(*) > 1)
GROUP BY filepath
""")
def q_collisions(spark, sf_dir):
    """Entry keys that several entries of a file share."""
    from ..operators import dedup
    return dedup.key_collisions(fixture_entries(spark, sf_dir))


@register("q_preview_job", O.with_(O.RAW_ENTRIES, O.ENTRIES, O.LOG, O.PENDING) + """
SELECT e.filepath, e.entry_idx, e.field, e.string_key, e.string_id, length(e.source_text) AS n_chars, e.status
FROM (SELECT *, 'preview' AS status FROM entries UNION ALL SELECT *, 'pending' FROM pending) e
""")
def q_preview_job(spark, sf_dir):
    """The preview of every entry written to a bucketed log that also holds
    translations: its preview rows, and what a job would still translate (unchanged)."""
    entries = fixture_entries(spark, sf_dir)
    path = scratch_path(spark, "preview-log")
    log = BucketedLog(spark, path, n_buckets=64)
    log.append(fixture_log_table(entries))
    pipeline.write_preview(entries, path, "p1")
    previews = log.read().filter("status = 'preview'").withColumn("entry_idx", F.col("pos"))
    both = [df.select("filepath", "entry_idx", "field", "string_key", "string_id",
                      F.length("source_text").cast("long").alias("n_chars"), F.lit(status).alias("status"))
            for df, status in ((previews, "preview"), (log.pending(entries), "pending"))]
    return both[0].unionByName(both[1])


@register("q_quarantine_apply", """
SELECT 'loc/' || lang || '-' || lang || '/' || source || '/' || doc_id || '.json.json' AS filepath,
       'apply' AS stage, 'invalid_json' AS reason
FROM documents WHERE doc_id % 50 IN (7, 17) AND doc_id % 3 > 0
""")
def q_quarantine_apply(spark, sf_dir):
    """Documents that the log names and that cannot be read at apply."""
    docs = json_docs(spark, sf_dir)
    log = docs.filter(F.col("doc_id") % 3 > 0).select("filepath")
    return ap.quarantine_touched(docs.drop("doc_id"), log)
