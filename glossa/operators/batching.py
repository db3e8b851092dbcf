"""Contiguous batch numbering in a global order.

The reference slices one Python list into chunks of ``batch_size``.  The chunk of a
unit therefore depends on its global position, which a plain ``row_number() OVER
(ORDER BY ...)`` computes in one task (``Exchange SinglePartition``).  Instead:

1. ``orderBy`` range-partitions the rows over many tasks and sorts each range;
2. each row records its range (``spark_partition_id``) and its position inside the
   range (from ``monotonically_increasing_id``) -- computed in the same task that
   sorted it, then written once to the shared folder so the values are fixed;
3. rows per range are counted (one row per range) and turned into start offsets;
4. the offsets (one row per range: bounded by the partition count, never by the data)
   are broadcast back; ``idx = offset + position``.

The only single-task step is the running sum over the per-range counts.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.models import validate_settings
from ..session import TEXT_CODEC, materialize


def global_index(df: DataFrame, order: list[Column], name: str = "idx",
                 partitions: int | None = None, keep_range: bool = False) -> DataFrame:
    """Add ``name`` = 0-based position of each row in the total order ``order``.
    ``keep_range`` leaves the number of the row's range in ``_range``: every file holds one
    range, so a filter on it skips the others.

    ``order`` must be a total order (unique per row) for the index to be reproducible.
    """
    # range partitioning first samples its input in a separate job; keep the input so
    # the upstream plan is not evaluated twice (lost blocks are recomputed from lineage)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # without an explicit count AQE may merge neighbouring ranges, which keeps order
        ranged = (cached.repartitionByRange(partitions, *order) if partitions
                  else cached.repartitionByRange(*order)).sortWithinPartitions(*order)
        pid = F.spark_partition_id()
        tagged = ranged.select("*", pid.alias("_range"),
                               (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))
                               .alias("_pos"))
        fixed = materialize(tagged, "ordered", codec=TEXT_CODEC)
    finally:
        cached.unpersist()
    counts = fixed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(
        "_range",
        (F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_start"))
    starts = starts.select("_range", F.coalesce("_start", F.lit(0)).alias("_start"))
    return (fixed.join(F.broadcast(starts), "_range")
                 .withColumn(name, F.col("_start") + F.col("_pos"))
                 .drop(*([] if keep_range else ["_range"]), "_pos", "_start"))


def assign_batches(units: DataFrame, order: list[Column], batch_size: int,
                   partitions: int | None = None, keep_range: bool = False) -> DataFrame:
    """``unit_idx``, ``batch_id = unit_idx div batch_size``, ``pos`` in the batch."""
    validate_settings(batch_size)
    indexed = global_index(units, order, "unit_idx", partitions, keep_range)
    return (indexed.withColumn("batch_id", F.floor(F.col("unit_idx") / batch_size).cast("long"))
                   .withColumn("pos", (F.col("unit_idx") % batch_size).cast("int")))


def unit_order(path_col: str = "filepath") -> list[Column]:
    """File order (by path component), group's first entry, female before male."""
    from ..functions.paths import path_parts
    return [path_parts(path_col), F.col("first_entry_idx"), F.col("variant_idx")]
