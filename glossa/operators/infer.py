"""Batch inference through a user-supplied function.

``fn_factory()`` is called once per task (the client is built once per partition, not
per batch) and returns ``fn(request: dict) -> str``: the reply text, or a provider
envelope when ``envelope`` names the provider shape.  The request dict carries
``batch_id, n, prompt, provider, model, body, texts`` and the ``attempt`` number.

A call that raises is made again by its task (``calls.call_many``): up to ``in_flight``
calls run at once in a task, and a batch that waits for its retry holds up no other.  A
reply that does not parse (the reference retries it as well, because its batch function
parses inside the retry loop) fails its attempt too; as the parse runs on the JVM
(``replies``), such batches are called again in the next round.  Attempts add up over rounds,
so a batch is called at most ``max_attempts`` times.  Each round's replies are
parsed as they come and written to the shared folder, so lazy re-evaluation never repeats a
paid call.  Requests are not written: each round builds those that it calls, so they must come
out the same each time (as ``requests.build_requests`` over batched units does).  ``parallelism`` (default: the cluster's cores) is the number of tasks per round,
so ``parallelism * in_flight`` bounds the calls in flight and ``calls_per_second`` their
rate over all tasks; batches are hash-spread over the tasks by id.  With ``in_flight``
above 1, ``fn`` is called from several threads.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RESPONSES
from ..session import TEXT_CODEC, materialize, settings
from .calls import call_many
from .replies import STATUS_OK, envelope_text, parse_replies

# --- fixed values -------------------------------------------------------------------
MAX_ATTEMPTS = 3
BACKOFF_BASE_SECONDS = 2.0   # wait base ** attempt between attempts: 2 s, then 4 s
# ------------------------------------------------------------------------------------

REQUEST_FIELDS = ("batch_id", "n", "prompt", "provider", "model", "body", "texts")
#: Column of a request that goes on to its result and that ``fn`` does not see.
UNITS = "units"


#: Requests that reach a task's Python together, replies that leave it together and those that a
#: scan of the written replies decodes together.  A request holds its batch's texts several times
#: over, so Spark's default of 10,000 rows would be a task's whole share of the job; so would the
#: 4,096 rows of a scan, as a reply holds its batch's texts and their translations.
REQUESTS_AT_ONCE = REPLIES_AT_ONCE = 32
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(REQUESTS_AT_ONCE)}


def _call_round(requests: DataFrame, fn_factory: Callable[[], Callable[[dict], str]], max_attempts: int,
                backoff_base: float, in_flight: int, calls_per_second: float | None) -> DataFrame:
    """One reply per request, whose column ``used`` counts the attempts of earlier rounds."""
    cols = [c for c in REQUEST_FIELDS if c in requests.columns] + ["used"]
    kept = [UNITS] if UNITS in requests.columns else []
    schema = T.StructType([*RESPONSES.fields, *(requests.schema[c] for c in kept)])

    def records(batches):
        for batch in batches:
            for i, rec in enumerate(batch.select(cols).to_pylist()):
                rec["attempt"] = rec.pop("used") + 1
                yield rec | {UNITS: [batch.column(c).slice(i, 1) for c in kept]}

    def frame(done):
        recs, raw, errors = zip(*done)
        return pa.RecordBatch.from_arrays(
            [*(pa.array([r[c] for r in recs], t) for c, t in (("batch_id", pa.int64()), ("n", pa.int32()),
                                                             ("attempt", pa.int32()))),
             pa.array(raw, pa.string()), pa.array(errors, pa.string()),
             *(pa.concat_arrays([r[UNITS][k] for r in recs]) for k in range(len(kept)))], names=schema.names)

    def run(batches):
        fn, done = fn_factory(), []
        seen = lambda rec: fn({k: v for k, v in rec.items() if k != UNITS})
        for reply in call_many(records(batches), seen, in_flight, max_attempts, backoff_base, calls_per_second):
            done.append(reply)
            if len(done) == REPLIES_AT_ONCE:
                yield frame(done)
                done = []
        if done:
            yield frame(done)

    return requests.select(*cols, *kept).mapInArrow(run, schema)


def run_batches(requests: DataFrame, fn_factory: Callable[[], Callable[[dict], str]],
                max_attempts: int = MAX_ATTEMPTS, backoff_base: float = BACKOFF_BASE_SECONDS,
                envelope: str | None = None, parallelism: int | None = None, in_flight: int = 1,
                calls_per_second: float | None = None) -> DataFrame:
    """Call every batch, retrying failed ones; return one row per batch:
    (batch_id, n, attempts, status, error, items), and the ``units`` of ok batches if the
    requests have them.  ``status`` is ``ok`` or the last
    failure reason (``error`` for an exception, else the parse status)."""
    if in_flight < 1:
        raise ValueError("in_flight must be at least 1")
    # calls in flight = tasks of a round * in_flight; batches are spread by id over that many tasks
    tasks = parallelism or requests.sparkSession.sparkContext.defaultParallelism
    rate = calls_per_second / tasks if calls_per_second else None
    todo = requests.withColumn("used", F.lit(0))
    finished: list[DataFrame] = []
    for number in range(1, max_attempts + 1):  # each round uses up an attempt of every batch left
        replies = _call_round(todo.repartition(tasks, "batch_id"), fn_factory, max_attempts,
                              backoff_base, in_flight, rate)
        if envelope:
            text, env_status = envelope_text(envelope)
            replies = replies.withColumn("reply", text).withColumn(
                "status", F.when(F.col("error").isNotNull(), F.lit("error")).otherwise(env_status))
        else:
            replies = replies.withColumn("reply", F.col("raw")).withColumn(
                "status", F.when(F.col("error").isNotNull(), F.lit("error")))
        ok_units = [F.when(F.col("status") == STATUS_OK, F.col(UNITS)).alias(UNITS)] if UNITS in replies.columns else []
        with settings(todo.sparkSession, FEW_ROWS):
            parsed = materialize(parse_replies(replies, "reply", "n").select(
                "batch_id", "n", F.col("attempt").alias("attempts"), "status", "error", "items", *ok_units),
                f"replies-{number}", codec=TEXT_CODEC, group_rows=REPLIES_AT_ONCE)
        again = (F.col("status") != STATUS_OK) & (F.col("attempts") < max_attempts)
        finished.append(parsed.filter(~again))
        if number == max_attempts or parsed.filter(again).isEmpty():
            break
        # written, so that its true size decides how it is joined with the requests
        left = materialize(parsed.filter(again).select("batch_id", F.col("attempts").alias("used")), "again")
        if backoff_base:
            time.sleep(backoff_base ** number)
        # only the units of these batches are read and moved again
        todo = requests.join(left, "batch_id", "left_semi").join(left, "batch_id")
    out = finished[0]
    for f in finished[1:]:
        out = out.unionByName(f)
    return out


def run_frontier(requests: DataFrame, fn_factory: Callable[[], Callable[[dict], str]],
                 max_attempts: int = MAX_ATTEMPTS, backoff_base: float = BACKOFF_BASE_SECONDS,
                 envelope: str | None = None, parallelism: int | None = None,
                 largest_slice: int | None = None, in_flight: int = 1,
                 calls_per_second: float | None = None) -> DataFrame:
    """I4: call the batches in order, slice by slice, and stop after the first slice in
    which a batch fails all attempts; batches beyond that slice are never called.

    The first slice has one batch for each task; every slice without a failure doubles the
    next, up to ``largest_slice`` (default 64 for each task), so a provider that is down
    costs one batch a task and a long run costs few slices.  The least failed id is
    the barrier between two slices: one aggregate over the slice's results.  Only the
    requests of slices that are called are built and written.

    Returns the results of every batch that was called, failed ones and those after them
    in their slice included, with its ``slice``; :func:`stop_at_first_failure` keeps what counts.
    """
    spark = requests.sparkSession
    tasks = parallelism or spark.sparkContext.defaultParallelism
    largest = largest_slice or 64 * tasks
    edge = requests.agg(F.min("batch_id").alias("lo"), F.max("batch_id").alias("hi")).first()
    if edge["lo"] is None:
        return run_batches(requests, fn_factory, max_attempts, backoff_base, envelope, tasks,
                           in_flight, calls_per_second).withColumn(
            "slice", F.lit(0))
    called: DataFrame | None = None
    at, size, number = edge["lo"], min(tasks, largest), 0
    while at <= edge["hi"]:
        part = requests.filter(F.col("batch_id").between(at, at + size - 1))
        results = run_batches(part, fn_factory, max_attempts, backoff_base, envelope, tasks,
                              in_flight, calls_per_second).withColumn(
            "slice", F.lit(number))
        called = results if called is None else called.unionByName(results)
        if not results.filter(F.col("status") != STATUS_OK).isEmpty():
            break
        at, size, number = at + size, min(2 * size, largest), number + 1
    return called


def stop_at_first_failure(results: DataFrame) -> DataFrame:
    """I4 parity mode: keep only batches before the first failed one.

    The default keeps every successful batch; this reproduces the reference, where
    the first batch that fails all attempts ends translation.  The first failed id is a
    scalar subquery (one aggregate value)."""
    first_bad = (results.filter(F.col("status") != STATUS_OK)
                        .select(F.coalesce(F.min("batch_id"), F.lit(2**63 - 1))).scalar())
    return results.filter(F.col("batch_id") < first_bad)
