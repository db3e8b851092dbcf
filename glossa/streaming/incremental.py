"""Incremental translation as a Structured Streaming job (ST1, K2, J1).

New locale documents arriving in a folder are picked up by the file source; its
checkpoint remembers which files were seen.  Each micro-batch runs the batch plan:
extract -> resume against the current log -> units -> batches -> inference -> append.
The resume step sits inside ``foreachBatch``, so replaying a micro-batch after a
failure appends nothing twice: rows already in the log are no longer pending.

``trigger(availableNow=True)`` processes what is there and stops (scheduled runs);
a processing-time trigger keeps the job running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import is_locale_path, relative_to
from ..operators import dedup, extract
from ..plans import pipeline
from ..session import TEXT_CODEC, materialize, scratch_scope
from ..sinks.bucketed_log import open_log
from ..sinks.files import read_published, write_published

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

DOC_TABLE_SCHEMA = T.StructType([
    T.StructField("filepath", T.StringType(), False),
    T.StructField("content", T.StringType(), True),
])


def document_stream(spark: SparkSession, source_dir: str, source: str = "binaryFile",
                    locale: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (filepath, content) rows: one per new ``*.json.json`` file
    (``binaryFile``) or one per row of new Parquet files holding documents."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if source == "binaryFile":
        df = (reader.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                    .option("pathGlobFilter", "*.json.json")
                    .option("recursiveFileLookup", "true").load(source_dir)
                    .select(relative_to(F.col("path"), source_dir).alias("filepath"), "content"))
    elif source == "parquet":
        df = reader.schema(DOC_TABLE_SCHEMA).parquet(source_dir)
    else:
        raise ValueError(f"unknown document source {source!r}")
    if locale:
        df = df.filter(is_locale_path(F.col("filepath"), locale))
    return df


def retry_path(log_path: str) -> str:
    """Entries whose batch failed all attempts, beside the log: one published version that
    every micro-batch replaces, since each one tries all of them again."""
    return log_path.rstrip("/") + "_retry"


def waiting(spark: SparkSession, log_path: str) -> DataFrame | None:
    """The failed strings that no later micro-batch has translated yet; None if there are none."""
    left = read_published(spark, retry_path(log_path))
    return None if left is None or left.isEmpty() else left


def still_waiting(entries: DataFrame, t: pipeline.Translation | None, failed: DataFrame | None) -> DataFrame:
    """The entries to try again: those of the units whose batch failed (both variants of a
    deduped pair), taken from the units by the failed ids, so no other text is moved.  An entry
    without path or string key waits for ever, since it equals no key of the log."""
    columns = entries.columns
    lost = entries.filter("filepath is null or string_key is null").distinct()
    if t is None or failed is None:
        return lost
    units = t.units.join(failed.select("batch_id"), "batch_id", "left_semi") \
                   .filter("filepath is not null and string_key is not null")
    return dedup.expand_dedup(units).select(*columns).unionByName(lost)


def run_incremental(spark: SparkSession, source_dir: str, log_path: str, checkpoint: str,
                    fn_factory: Callable[[], Callable[[dict], str]], source_lang: str,
                    target_lang: str, provider: str = "anthropic",
                    model: str = "claude-sonnet-4-20250514", batch_size: int = 40,
                    source: str = "binaryFile", locale: str | None = None,
                    max_files_per_trigger: int | None = None, backoff_base: float = 2.0,
                    available_now: bool = True, log_buckets: int | None = None):
    """Start the stream; with ``available_now`` it processes all new input and stops.
    ``log_buckets`` starts the log bucketed by path (``sinks.bucketed_log``), so that a
    micro-batch reads only the buckets of its files.  Returns the finished (or running)
    ``StreamingQuery``."""
    stream = document_stream(spark, source_dir, source, locale, max_files_per_trigger)

    started = pipeline.new_run_id()

    def translate_entries(spark: SparkSession, new: DataFrame | None, run_id: str) -> None:
        with scratch_scope(spark):
            again = waiting(spark, log_path)
            if new is None and again is None:
                return
            entries = again if new is None else new if again is None else \
                new.unionByName(again.select(*new.columns))
            # read and parsed once per micro-batch; what is waiting may be among the new rows,
            # too (a replayed micro-batch), which changes no unit
            entries = materialize(entries, "stream-entries", codec=TEXT_CODEC)
            log = open_log(spark, log_path, log_buckets)
            # only the log rows of files in this micro-batch can match: the log is reduced to
            # its buckets (or paths) before keys are de-duplicated for the anti join
            t = pipeline.translate(entries, log.for_entries(entries), fn_factory, source_lang, target_lang,
                                   provider, model, batch_size, run_id=run_id, backoff_base=backoff_base)
            failed = None
            if t is not None:
                log.append(t.records)
                # written, so that its true size decides how it is joined with the units
                failed = materialize(pipeline.failed_batches(t.results, t.units, run_id), "failed")
            lasting = failed is not None and not failed.isEmpty()
            if lasting:
                failed.write.mode("append").parquet(pipeline.failures_path(log_path))
            if lasting or again is not None:
                # the checkpoint moves on, so what is left is kept for the next micro-batch
                write_published(still_waiting(entries, t, failed), retry_path(log_path))

    def one_batch(batch: DataFrame, epoch_id: int) -> None:
        # ids of one start sort by epoch, those of a later start come after them
        translate_entries(batch.sparkSession, extract.extract_entries(batch), f"{started}_e{epoch_id:08d}")

    translate_entries(spark, None, f"{started}_retry")  # even if no new file arrives
    writer = (stream.writeStream.foreachBatch(one_batch)
                    .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
