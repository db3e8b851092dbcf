"""Several provider calls in flight within one task.

A task hands its requests to a bounded pool and takes replies in whatever order they come.
A call that raises is made again by the same task after ``backoff_base ** attempt`` seconds;
meanwhile its slot serves other requests.  A token bucket spaces the calls.  At most
``in_flight`` requests are being called and ``WAITING * in_flight`` wait for a retry, so a
task's memory does not depend on the size of its partition.
"""

from __future__ import annotations

import heapq
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

#: Requests that may wait for their retry, for each call in flight; beyond it no new ones start.
WAITING = 4


class TokenBucket:
    """``rate`` calls a second on the long run, at most ``burst`` at once; None: no limit."""

    def __init__(self, rate: float | None, burst: float = 1.0, clock: Callable[[], float] = time.monotonic):
        if rate is not None and rate <= 0:
            raise ValueError("calls_per_second must be positive")
        self.rate, self.burst, self.clock = rate, max(1.0, burst), clock
        self.tokens, self.at = self.burst, clock()

    def seconds_left(self) -> float:
        """Seconds until a call may start, 0 if it may now."""
        if self.rate is None:
            return 0.0
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        return max(0.0, (1.0 - self.tokens) / self.rate)

    def take(self) -> None:
        if self.rate is not None:
            self.tokens -= 1.0


def call_many(records: Iterable[dict], fn: Callable[[dict], str], in_flight: int, max_attempts: int,
              backoff_base: float, calls_per_second: float | None = None) -> Iterator[tuple[dict, str | None, str | None]]:
    """(record, reply, error) of every record as its last call ends; ``record['attempt']`` is
    that call's number.  An exception is tried again up to attempt ``max_attempts``."""
    def one(record: dict):
        try:
            return fn(record), None
        except Exception as e:  # noqa: BLE001 - any failure is a failed attempt
            return None, f"{type(e).__name__}: {e}".strip()

    source, more = iter(records), True
    waiting: list[tuple[float, int, dict]] = []  # by due time, then by order of failure
    running: dict = {}
    bucket, failures = TokenBucket(calls_per_second), 0
    pool = ThreadPoolExecutor(in_flight)
    try:
        while True:
            pause = None  # seconds until the next call may start; None: only an ending call matters
            while len(running) < in_flight:
                now = time.monotonic()
                fresh = more and len(waiting) < WAITING * in_flight
                if not fresh and not waiting:
                    break
                pause = max(bucket.seconds_left(), 0.0 if fresh else waiting[0][0] - now)
                if pause > 0:
                    break
                if waiting and waiting[0][0] <= now:
                    record = heapq.heappop(waiting)[2]
                else:
                    record = next(source, None)
                    if record is None:
                        more, pause = False, None
                        continue
                bucket.take()
                running[pool.submit(one, record)] = record
                pause = None
            if not running:
                if pause is None:
                    return
                time.sleep(pause)
                continue
            for call in wait(running, timeout=pause, return_when=FIRST_COMPLETED).done:
                record = running.pop(call)
                reply, error = call.result()
                if error is not None and record["attempt"] < max_attempts:
                    failures += 1
                    due = time.monotonic() + (backoff_base ** record["attempt"] if backoff_base else 0.0)
                    heapq.heappush(waiting, (due, failures, record | {"attempt": record["attempt"] + 1}))
                else:
                    yield record, reply, error
    finally:  # also when Spark ends the task early
        pool.shutdown(wait=False, cancel_futures=True)
