"""The translation job as one composed plan (I5, SURVEY 3.1).

    entries -> resume (J1) -> units (A1, A2) -> batches (W1) -> requests (B1, B2)
            -> inference rounds (I1-I4) -> records (J4, J3) -> log (K2)
    entries + log -> apply (J2, C1) -> documents (C2, K3) + gates (A7, A11)

No step loops over rows on the driver; the only driver loop is over attempt rounds.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.models import check_provider, validate_settings
from ..operators import apply as apply_op
from ..operators import batching, dedup, gates, infer, records, requests
from ..schemas import DEFAULT_BATCH_SIZE, TRANSLATION_LOG
from ..session import scratch_scope


def new_run_id(now: _dt.datetime | None = None) -> str:
    """run id ``YYYYMMDD_HHMMSS``."""
    return (now or _dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


@dataclass
class Translation:
    units: DataFrame          # batched units (materialized)
    requests: DataFrame
    results: DataFrame        # one row per batch: status, attempts, items
    records: DataFrame        # new log rows of this run


def plan_batches(entries: DataFrame, log: DataFrame | None, batch_size: int,
                 partitions: int | None = None, keep_range: bool = False) -> DataFrame:
    """J1 -> A1/A2 -> W1: the units still to translate, numbered into batches."""
    validate_settings(batch_size)
    done = records.keep_translated(log) if log is not None else None
    units = dedup.plan_units(None, dedup.group_pending(entries, done))
    return batching.assign_batches(units, batching.unit_order(), batch_size, partitions, keep_range)


def translate(entries: DataFrame, log: DataFrame | None,
              fn_factory: Callable[[], Callable[[dict], str]],
              source_lang: str, target_lang: str, provider: str = "anthropic",
              model: str = "claude-sonnet-4-20250514", batch_size: int = DEFAULT_BATCH_SIZE,
              run_id: str | None = None, max_attempts: int = infer.MAX_ATTEMPTS,
              backoff_base: float = infer.BACKOFF_BASE_SECONDS, envelope: str | None = None,
              stop_on_failure: bool = False, title: str = requests.DEFAULT_TITLE,
              parallelism: int | None = None, in_flight: int = 1,
              calls_per_second: float | None = None) -> Translation | None:
    """I5.  Returns None when nothing is pending (the reference exits early before it
    even checks the provider, B3).

    The returned DataFrames read intermediate tables in the shared folder; run the
    call and the consumption of its results inside ``session.scratch_scope(spark)``
    to remove those tables afterwards (``run_translation_job`` does this itself)."""
    run_id = run_id or new_run_id()
    units = plan_batches(entries, log, batch_size)
    if units.isEmpty():
        return None
    check_provider(provider)
    reqs = requests.build_requests(units, source_lang, target_lang, provider, model, title, parallelism, True)
    call = infer.run_frontier if stop_on_failure else infer.run_batches
    results = call(reqs, fn_factory, max_attempts, backoff_base, envelope, parallelism,
                   in_flight=in_flight, calls_per_second=calls_per_second)
    if stop_on_failure:
        results = infer.stop_at_first_failure(results)
    recs = records.records_from_results(units, results, run_id)
    return Translation(units, reqs, results, recs)


def empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], TRANSLATION_LOG)


def apply_and_rebuild(docs: DataFrame, entries: DataFrame, log: DataFrame,
                      require_updates: bool = True):
    """C1 + C2 + A11: patched entries, rewritten documents of touched files, counts."""
    log = records.keep_translated(log)
    patched = apply_op.apply_log(entries, log)
    counts = apply_op.apply_counts(patched)
    if require_updates:
        gates.zero_update_gate(counts)
    touched = apply_op.touched_documents(docs, log)
    rebuilt = apply_op.rebuild_documents(touched, patched)
    return patched, rebuilt, counts


def write_preview(entries: DataFrame, log_path: str, run_id: str | None = None,
                  log_buckets: int | None = None) -> str:
    """K4: extraction without translation: append every entry to the log as a preview
    (empty text, status ``preview``), which neither resume nor apply counts.  Returns the
    run's id."""
    from ..sinks.bucketed_log import open_log
    run_id = run_id or new_run_id()
    open_log(entries.sparkSession, log_path, log_buckets).append(records.preview_records(entries, run_id))
    return run_id


def echo_translator(prefix: str = "[xx] ") -> Callable[[], Callable[[dict], str]]:
    """Deterministic stand-in for a provider: prefixes every text.  Used by tests and
    by the registered queries; real providers are user code with the same shape."""
    def factory():
        def fn(req: dict) -> str:
            return json.dumps([prefix + t for t in req["texts"]], ensure_ascii=False)
        return fn
    return factory


def failing_translator(fails: Callable[[dict], bool], prefix: str = "[xx] "):
    """Like :func:`echo_translator`, but raises for requests where ``fails(req)``."""
    def factory():
        def fn(req: dict) -> str:
            if fails(req):
                raise RuntimeError(f"provider error for batch {req['batch_id']}")
            return json.dumps([prefix + t for t in req["texts"]], ensure_ascii=False)
        return fn
    return factory


def run_translation_job(entries: DataFrame, log_path: str,
                        fn_factory: Callable[[], Callable[[dict], str]],
                        source_lang: str, target_lang: str, provider: str = "anthropic",
                        model: str = "claude-sonnet-4-20250514",
                        batch_size: int = DEFAULT_BATCH_SIZE, wave_batches: int | None = 10_000,
                        n_waves: int | None = None,
                        run_id: str | None = None, max_attempts: int = infer.MAX_ATTEMPTS,
                        backoff_base: float = infer.BACKOFF_BASE_SECONDS,
                        envelope: str | None = None, title: str = requests.DEFAULT_TITLE,
                        parallelism: int | None = None, metrics_path: str | None = None,
                        stop_on_failure: bool = False, log_buckets: int | None = None,
                        in_flight: int = 1, calls_per_second: float | None = None) -> int:
    """K2 at scale: translate in waves of ``wave_batches`` batches and append each
    wave's records to the log before the next wave starts.

    A crash (even of the driver) loses at most the wave in flight: rerunning the job
    resumes from the log (J1), like the reference's log rewrite after every batch but
    with appends only.  The batched units are written once, in order, and a wave reads
    only the files of its ranges (filter pushdown); the driver loop is over
    waves, never over rows.  ``n_waves`` sizes the waves by count instead.  Returns
    the number of waves run.  With ``metrics_path``, counters of the run (D11: units,
    deduped pairs, ok/failed batches, records, elapsed seconds) are appended there as
    ``run_metrics`` rows; each counter is one aggregate over a materialized table.
    Intermediate tables of the job are removed once its results are in the log.

    ``stop_on_failure`` (I4) stops at the first batch that fails all attempts: each wave
    runs slice by slice (``infer.run_frontier``), its records before that batch are
    appended, and neither the later slices nor the later waves are called.  ``log_buckets``
    starts the log as snapshot and deltas by path bucket (``sinks.bucketed_log``); a log
    that has that layout keeps it.  ``in_flight`` and ``calls_per_second``: see
    ``operators.infer``.
    """
    started = time.time()
    metrics: list[tuple[str, str, float]] = []
    with scratch_scope(entries.sparkSession):
        return _run_waves(entries, log_path, fn_factory, source_lang, target_lang, provider,
                          model, batch_size, wave_batches, n_waves, run_id, max_attempts,
                          backoff_base, envelope, title, parallelism, metrics_path, started,
                          metrics, stop_on_failure, log_buckets, in_flight, calls_per_second)


def _run_waves(entries, log_path, fn_factory, source_lang, target_lang, provider, model,
               batch_size, wave_batches, n_waves, run_id, max_attempts, backoff_base,
               envelope, title, parallelism, metrics_path, started, metrics, stop_on_failure,
               log_buckets, in_flight, calls_per_second) -> int:
    from ..sinks.bucketed_log import open_log
    spark = entries.sparkSession
    run_id = run_id or new_run_id()
    log = open_log(spark, log_path, log_buckets)
    units = plan_batches(entries, log.for_resume(entries), batch_size, keep_range=True)
    top = units.agg(F.max("batch_id").alias("m")).first()["m"]
    if top is None:
        return 0
    check_provider(provider)
    if n_waves:
        wave_batches = -(-(top + 1) // n_waves)
    # a wave is a stretch of the ordered units: its first and last range, one row per wave
    wave_of = F.floor(F.col("batch_id") / wave_batches).cast("long")
    spans = {r["w"]: (r["lo"], r["hi"]) for r in units.groupBy(wave_of.alias("w")).agg(
        F.min("_range").alias("lo"), F.max("_range").alias("hi")).collect()}
    if metrics_path:
        plan = units.agg(F.count(F.lit(1)).alias("u"), F.count_if("is_dedup").alias("d")).first()
        metrics += [("plan", "units", plan["u"]), ("plan", "deduped_pairs", plan["d"]),
                    ("plan", "batches", top + 1)]
    waves = 0
    for w in range(0, top // wave_batches + 1):
        wave = units.filter((wave_of == w) & F.col("_range").between(*spans[w])).drop("_range")
        reqs = requests.build_requests(wave, source_lang, target_lang, provider, model, title, parallelism, True)
        call = infer.run_frontier if stop_on_failure else infer.run_batches
        results = call(reqs, fn_factory, max_attempts, backoff_base, envelope, parallelism,
                       in_flight=in_flight, calls_per_second=calls_per_second)
        done = infer.stop_at_first_failure(results) if stop_on_failure else results
        new = records.records_from_results(wave, done, run_id)
        log.append(new)
        failed = failed_batches(results, wave, run_id)
        if not failed.isEmpty():
            failed.write.mode("append").parquet(failures_path(log_path))
            if stop_on_failure:
                waves += 1
                break
            if results.filter(F.col("status") == "ok").isEmpty():
                # the provider is down: stop before the next wave is paid for
                raise RuntimeError(f"every batch of wave {w} failed; see {failures_path(log_path)}")
        if metrics_path:
            r = results.agg(F.count_if(F.col("status") == "ok").alias("ok"),
                            F.count_if(F.col("status") != "ok").alias("failed")).first()
            metrics += [(f"wave{w}", "batches_ok", r["ok"]), (f"wave{w}", "batches_failed", r["failed"])]
        waves += 1
    if metrics_path:
        written = log.read().filter(F.col("run_id") == run_id).count()
        metrics += [("run", "records", written), ("run", "waves", waves),
                    ("run", "elapsed_seconds", round(time.time() - started, 3))]
        write_metrics(spark, run_id, metrics, metrics_path)
    return waves


def failures_path(log_path: str) -> str:
    """Table of failed batches beside the log."""
    return log_path.rstrip("/") + "_failures"


def failed_batches(results: DataFrame, units: DataFrame, run_id: str) -> DataFrame:
    """One row per batch that failed all attempts: its files, attempts, status and
    whole error text.  Its strings stay pending for the next run."""
    bad = results.filter(F.col("status") != "ok").select("batch_id", "n", "attempts", "status", "error")
    files = units.join(bad.select("batch_id"), "batch_id", "left_semi").groupBy("batch_id").agg(F.sort_array(F.collect_set("filepath")).alias("files"))
    return bad.join(files, "batch_id").select(F.lit(run_id).alias("run_id"), "*")


def write_metrics(spark, run_id: str, metrics: list[tuple[str, str, float]], path: str) -> None:
    """Append (run_id, stage, metric, value) rows, one folder per run."""
    from ..schemas import RUN_METRICS
    rows = [(run_id, stage, metric, float(value)) for stage, metric, value in metrics]
    (spark.createDataFrame(rows, RUN_METRICS).coalesce(1)
          .write.mode("append").partitionBy("run_id").parquet(path))
