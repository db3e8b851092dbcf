"""The translation log as snapshot and deltas, bucketed by file path.

A plain log is scanned whole by every job and micro-batch that resumes from it.  Here every
append writes one *generation* of rows, partitioned by a hash bucket of ``filepath``, and
then commits a numbered manifest that lists it; a generation that no manifest lists does
not exist for readers, so an append is seen whole or not at all.  :meth:`BucketedLog.compact`
folds the generations into a *snapshot*: the last translated record of every key.

* *resume* (J1) reads the snapshot and the deltas since, of the buckets its entries fall
  into, and of these only the key columns; a micro-batch that touches three files reads three buckets
  at most (``PartitionFilters`` in the plan);
* *history* (T17) stays: compaction never deletes the generations it folded, they only
  leave the resume view.  :meth:`BucketedLog.read` is the whole log in the log's schema.

The driver holds the manifest (one short id per generation) and the numbers of the touched
buckets, at most ``n_buckets``.  Rows are dealt to bucket files by a rebalancing shuffle,
which splits a bucket that one path fills.  A writer takes the next free manifest number; if
another was faster, it commits again on top of that one's manifest.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import LOG_COLUMNS, LOG_ORDER, keep_translated, run_rank
from ..operators.resume import normalize_ids, pending
from ..schemas import ENTRY_KEY, TRANSLATION_LOG
from ..session import TEXT_CODEC
from . import manifests

DEFAULT_BUCKETS = 256
#: Deltas after which an append compacts.
COMPACT_AFTER = 32


@dataclass(frozen=True)
class State:
    """One manifest: which generations readers see."""
    n_buckets: int
    snapshot: str | None = None
    deltas: tuple[str, ...] = ()
    #: Generations folded into the snapshot; part of the log, not of the resume view.
    folded: tuple[str, ...] = ()
    number: int = field(default=-1, compare=False)


def current_state(spark: SparkSession, root: str) -> State | None:
    """What the newest manifest says; None if there is no bucketed log at ``root``."""
    number, found = manifests.newest(spark, root)
    if found is None or "n_buckets" not in found:
        return None
    return State(found["n_buckets"], found["snapshot"], tuple(found["deltas"]), tuple(found["folded"]), number)


def bucket_of(n_buckets: int, path: str = "filepath") -> Column:
    return F.pmod(F.xxhash64(F.col(path)), F.lit(n_buckets)).cast("int")


def is_bucketed(spark: SparkSession, root: str) -> bool:
    return current_state(spark, root) is not None


class BucketedLog:
    """A log at ``root``; created with ``n_buckets`` buckets by the first append."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = DEFAULT_BUCKETS,
                 compact_after: int = COMPACT_AFTER):
        self.spark, self.root = spark, root.rstrip("/")
        self.n_buckets, self.compact_after = n_buckets, compact_after

    def state(self) -> State:
        return current_state(self.spark, self.root) or State(self.n_buckets)

    # -- writing -------------------------------------------------------------------------

    def _write(self, rows: DataFrame, n_buckets: int) -> str:
        """One generation: rows by bucket, large buckets over several files and tasks."""
        name = uuid.uuid4().hex
        dealt = rows.select(*LOG_COLUMNS).withColumn("bucket", bucket_of(n_buckets))
        (dealt.hint("rebalance", "bucket").write.option("compression", TEXT_CODEC)
              .partitionBy("bucket").parquet(f"{self.root}/gen={name}"))
        return name

    def _replace(self, change) -> State:
        """Commit ``change(state)`` on top of whatever is current."""
        while True:
            state = self.state()
            after = change(state)
            if after is None:
                return state
            body = {k: v for k, v in asdict(after).items() if k != "number"}
            if manifests.commit(self.spark, self.root, state.number + 1, body):
                return replace(after, number=state.number + 1)

    def append(self, records: DataFrame) -> None:
        """K2: add rows; readers see all of them or none."""
        name = self._write(records, self.state().n_buckets)
        after = self._replace(lambda s: replace(s, deltas=(*s.deltas, name)))
        if len(after.deltas) >= self.compact_after:
            self.compact()

    def compact(self) -> None:
        """Fold the deltas into a new snapshot.  A second compaction at the same time
        finds its deltas gone and commits nothing."""
        seen = self.state()
        if not seen.deltas:
            return
        name = self._write(self._last(self._generations(seen)), seen.n_buckets)

        def swap(s: State) -> State | None:
            if s.snapshot != seen.snapshot or s.deltas[:len(seen.deltas)] != seen.deltas:
                return None
            return replace(s, snapshot=name, deltas=s.deltas[len(seen.deltas):], folded=(*s.folded, *seen.deltas))

        self._replace(swap)

    @staticmethod
    def _last(rows: DataFrame) -> DataFrame:
        """The last translated record of every key, whole."""
        order = F.struct(*[run_rank() if c == "run_id" else F.col(c) for c in LOG_ORDER])
        rest = [c for c in LOG_COLUMNS if c not in ENTRY_KEY]
        last = normalize_ids(keep_translated(rows)).groupBy(*ENTRY_KEY).agg(
            F.max_by(F.struct(*rest), order).alias("_last"))
        return last.select(*ENTRY_KEY, *[F.col(f"_last.{c}").alias(c) for c in rest])

    # -- reading -------------------------------------------------------------------------

    def _load(self, names: tuple[str, ...]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], TRANSLATION_LOG).withColumn("bucket", F.lit(0))
        schema = self.spark.createDataFrame([], TRANSLATION_LOG).withColumn("bucket", F.lit(0)).schema
        return (self.spark.read.schema(schema).option("basePath", self.root)
                    .parquet(*[f"{self.root}/gen={n}" for n in names]))

    def _generations(self, state: State) -> DataFrame:
        return self._load((*((state.snapshot,) if state.snapshot else ()), *state.deltas))

    def read(self) -> DataFrame:
        """Every row ever appended, in the schema of the log."""
        state = self.state()
        return self._load((*state.folded, *state.deltas)).select(*LOG_COLUMNS)

    def latest(self) -> DataFrame:
        """The resume view: the snapshot and the rows since (a key may occur in both)."""
        return self._generations(self.state()).select(*LOG_COLUMNS)

    def for_entries(self, entries: DataFrame) -> DataFrame:
        """The resume view of the buckets that ``entries`` fall into."""
        state = self.state()
        touched = [r["b"] for r in entries.select(bucket_of(state.n_buckets).alias("b")).distinct().collect()]
        rows = self._generations(state)
        if len(touched) < state.n_buckets:
            rows = rows.filter(F.col("bucket").isin(sorted(touched)))
        return rows.select(*LOG_COLUMNS)

    #: A job resumes from the same rows as a micro-batch.
    for_resume = for_entries

    def pending(self, entries: DataFrame) -> DataFrame:
        """Entries without a translated record, reading only their buckets."""
        return pending(entries, self.for_entries(entries))


class PlainLog:
    """The log as one Parquet table, with the same calls."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def append(self, records: DataFrame) -> None:
        from ..operators.records import append_log
        append_log(records, self.root)

    def read(self) -> DataFrame:
        from ..session import has_data
        if not has_data(self.spark, self.root):
            return self.spark.createDataFrame([], TRANSLATION_LOG)
        return self.spark.read.parquet(self.root)

    def for_resume(self, entries: DataFrame) -> DataFrame:
        """The whole table: a job over all files needs most of it."""
        return self.read()

    def for_entries(self, entries: DataFrame) -> DataFrame:
        """The log's rows of the files that ``entries`` name."""
        return self.read().join(entries.select("filepath").distinct(), "filepath", "left_semi")


def open_log(spark: SparkSession, root: str, n_buckets: int | None = None) -> "BucketedLog | PlainLog":
    """The log at ``root`` in the layout it has; a new one is bucketed if ``n_buckets`` says so."""
    if n_buckets or is_bucketed(spark, root):
        return BucketedLog(spark, root, n_buckets or DEFAULT_BUCKETS)
    return PlainLog(spark, root)
