import json
import threading
import time
from collections import Counter

import pytest

from glossa.operators import infer
from glossa.operators.calls import WAITING, TokenBucket, call_many


def _records(n):
    return ({"batch_id": i, "attempt": 1} for i in range(n))


def test_calls_overlap_up_to_the_bound_and_end_in_any_order():
    lock, now, peak = threading.Lock(), [0], [0]
    met = threading.Barrier(3, timeout=20)  # breaks unless three calls run at once

    def fn(rec):
        with lock:
            now[0] += 1
            peak[0] = max(peak[0], now[0])
        met.wait()
        time.sleep(0.01 * (3 - rec["batch_id"] % 3))
        with lock:
            now[0] -= 1
        return str(rec["batch_id"])

    got = list(call_many(_records(9), fn, 3, 1, 0))
    assert peak[0] == 3 and [e for _, _, e in got] == [None] * 9
    assert sorted(int(raw) for _, raw, _ in got) == list(range(9))
    assert [r["batch_id"] for r, _, _ in got] != list(range(9))
    assert all(str(r["batch_id"]) == raw for r, raw, _ in got)


def test_a_waiting_retry_holds_up_no_other_batch():
    order = []

    def fn(rec):
        order.append((rec["batch_id"], rec["attempt"], time.monotonic()))
        if rec["batch_id"] == 0 and rec["attempt"] < 3:
            raise OSError("busy")
        return "x"

    got = {r["batch_id"]: (r["attempt"], e) for r, _, e in call_many(_records(6), fn, 1, 3, 0.3)}
    assert got == {0: (3, None), **{i: (1, None) for i in range(1, 6)}}
    assert [i for i, _, _ in order] == [0, 1, 2, 3, 4, 5, 0, 0]
    zero = [t for i, _, t in order if i == 0]
    assert zero[1] - zero[0] >= 0.3 and zero[2] - zero[1] >= 0.09


def test_a_dead_provider_pulls_a_bounded_number_of_requests():
    pulled, calls = [0], Counter()

    def source():
        for rec in _records(200):
            pulled[0] += 1
            yield rec

    def fn(rec):
        calls[rec["batch_id"]] += 1
        open_now.append(pulled[0] - ended[0])
        raise ValueError("down")

    ended, open_now, errors = [0], [], []
    for _, raw, error in call_many(source(), fn, 2, 3, 0.001):
        ended[0] += 1
        errors.append((raw, error))
    assert errors == [(None, "ValueError: down")] * 200 and set(calls.values()) == {3} and len(calls) == 200
    assert max(open_now) <= 2 + 2 * WAITING + 2


def test_token_bucket():
    at = [0.0]
    bucket = TokenBucket(2.0, burst=3, clock=lambda: at[0])
    for _ in range(3):
        assert bucket.seconds_left() == 0
        bucket.take()
    assert bucket.seconds_left() == 0.5
    at[0] = 0.5
    assert bucket.seconds_left() == 0
    at[0] = 100.0
    assert bucket.seconds_left() == 0 and bucket.tokens == 3
    assert TokenBucket(None).seconds_left() == 0
    with pytest.raises(ValueError):
        TokenBucket(0)


def test_rate_holds_over_retries():
    starts = []

    def fn(rec):
        starts.append(time.monotonic())
        if rec["attempt"] == 1:
            raise OSError("busy")
        return "x"

    assert len(list(call_many(_records(5), fn, 4, 2, 0, calls_per_second=50))) == 5
    assert len(starts) == 10 and max(starts) - min(starts) >= 9 / 50 - 0.01
    assert list(call_many(iter(()), fn, 4, 2, 0, calls_per_second=50)) == []


def test_attempts_add_up_over_tasks_and_rounds(spark, tmp_path):
    """Raised calls are repeated by their task, unparsable replies by the next round."""
    seen = tmp_path / "calls"
    seen.mkdir()
    plan = {0: ["ok"], 1: ["raise", "ok"], 2: ["bad", "ok"], 3: ["raise", "bad", "ok"], 4: ["bad", "raise", "ok"],
            5: ["raise", "raise", "raise"], 6: ["bad", "bad", "bad"], 7: ["bad", "raise", "raise"]}
    reqs = spark.createDataFrame([(i, 1, f"p{i}", [f"t{i}"]) for i in plan],
                                 "batch_id long, n int, prompt string, texts array<string>")

    def factory():
        def fn(req):
            (seen / f"{req['batch_id']}-{req['attempt']}").touch(exist_ok=False)
            what = plan[req["batch_id"]][req["attempt"] - 1]
            if what == "raise":
                raise RuntimeError("down")
            return json.dumps(req["texts"]) if what == "ok" else "no json"
        return fn

    out = {r.batch_id: (r.attempts, r.status, r.error) for r in infer.run_batches(
        reqs, factory, 3, 0, parallelism=2, in_flight=3).collect()}
    assert len(list(seen.iterdir())) == sum(map(len, plan.values()))
    for i, steps in plan.items():
        attempts, status, error = out[i]
        assert attempts == len(steps)
        assert (status == "ok") == (steps[-1] == "ok")
        assert (error == "RuntimeError: down") == (steps[-1] == "raise")
    empty = infer.run_batches(reqs.limit(0), factory, 3, 0, parallelism=2, in_flight=3)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        infer.run_batches(reqs, factory, in_flight=0)


def test_a_task_holds_few_requests(spark):
    """Requests reach Python some at a time, however many a task has."""
    reqs = spark.range(0, 600, 1, 1).selectExpr("id as batch_id", "1 as n", "'p' as prompt", "array('t') as texts")

    def factory():
        import gc

        def fn(req):
            return json.dumps([sum(isinstance(o, dict) and "prompt" in o for o in gc.get_objects())])
        return fn

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = infer.run_batches(reqs, factory, 1, 0, parallelism=1).collect()
    assert len(out) == 600 and max(int(r["items"][0]) for r in out) <= 100
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_a_scan_of_replies_decodes_few_rows(spark):
    """A Parquet scan decodes up to 4,096 rows at once, but none beyond a row group; a reply
    holds its batch's texts, so the groups hold few of them.  The results are whole."""
    import pyarrow.parquet as pq
    reqs = spark.range(0, 600, 1, 1).selectExpr("id as batch_id", "1 as n", "'p' as prompt", "array(cast(id as string)) as texts")
    results = infer.run_batches(reqs, lambda: lambda req: json.dumps(req["texts"]), 1, 0, parallelism=1)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in results.inputFiles()]
    rows = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(rows) == 600 and max(rows) <= infer.REPLIES_AT_ONCE
    assert sorted((r.batch_id, r.items) for r in results.collect()) == [(i, [str(i)]) for i in range(600)]
