"""Translation units: group pending entries, keep the last duplicate, drop identical
variant pairs (A1, A2, A5, J3, J6, O5, T3, T13).

Grouping is on (filepath, string_key, string_id) with NULL ids grouped together, as a
Python dict keyed by a tuple does.  Per group and field the entry with the largest
``entry_idx`` wins (later entries overwrite earlier ones); the group's position is its
first appearance.  The aggregate is map-side combined, so one hot group costs one row
per input partition in the shuffle, not its full size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENTRY_KEY, GROUP_KEY, VARIANT_FIELDS
from .resume import done_keys, normalize_ids


def _last(field: str) -> F.Column:
    val = F.struct(F.col("entry_idx"), F.col("variant_idx"), F.col("source_text"))
    return F.max_by(F.when(F.col("field") == field, val),
                    F.when(F.col("field") == field, F.col("entry_idx")))


def group_entries(pending: DataFrame) -> DataFrame:
    """A1: one row per group with the winning female and male entries."""
    return pending.groupBy(*GROUP_KEY).agg(
        _last(VARIANT_FIELDS[0]).alias("female"),
        _last(VARIANT_FIELDS[1]).alias("male"),
        F.min(F.struct("entry_idx", "variant_idx")).alias("first"),
    )


def group_pending(entries: DataFrame, log: DataFrame | None) -> DataFrame:
    """J1 + A1: :func:`group_entries` of the entries that the log does not hold (``pending``).

    The log's keys take part in the grouping as rows without text, so an entry's text is
    shuffled once, not for an anti join and again for the groups.  As in that join, a key
    with a NULL path or string key is never done."""
    entries = normalize_ids(entries)
    if log is None:
        return group_entries(entries)
    cols = [*ENTRY_KEY, "entry_idx", "variant_idx", "source_text"]
    kinds = dict(entries.dtypes)
    keys = done_keys(log, distinct=False).filter(F.col("filepath").isNotNull() & F.col("string_key").isNotNull())
    keys = keys.select(*ENTRY_KEY, *[F.lit(None).cast(kinds[c]).alias(c) for c in cols[len(ENTRY_KEY):]],
                       F.lit(True).alias("_done"))
    rows = entries.select(*cols, F.lit(False).alias("_done")).unionByName(keys)
    female, male = VARIANT_FIELDS
    place = F.when(~F.col("_done"), F.struct("entry_idx", "variant_idx"))
    per_field = {name: (F.max((F.col("field") == field) & F.col("_done")), F.min(F.when(F.col("field") == field, place)))
                 for name, field in (("female", female), ("male", male))}
    g = rows.groupBy(*GROUP_KEY).agg(
        _last(female).alias("female"), _last(male).alias("male"),
        *[x.alias(f"_{name}_{kind}") for name, both in per_field.items() for x, kind in zip(both, ("done", "first"))])
    left = lambda name, col: F.when(~F.coalesce(F.col(f"_{name}_done"), F.lit(False)), F.col(col))
    return g.select(*GROUP_KEY, left("female", "female").alias("female"), left("male", "male").alias("male"),
                    F.least(left("female", "_female_first"), left("male", "_male_first")).alias("first"))


def _is_dedup(f, m):
    return f.isNotNull() & m.isNotNull() & (f.source_text == m.source_text)


def plan_units(pending: DataFrame | None, grouped: DataFrame | None = None) -> DataFrame:
    """A2: units to translate.  An identical female/male pair becomes one female unit
    marked ``is_dedup``; otherwise each present variant is a unit.

    Columns: GROUP_KEY, first_entry_idx, variant_idx, field, entry_idx, source_text,
    is_dedup.  Unit order (O5) is (file order, first_entry_idx, variant_idx).
    """
    g = grouped if grouped is not None else group_entries(pending)
    f, m = F.col("female"), F.col("male")
    is_dedup = _is_dedup(f, m)
    unit = lambda s, name: F.struct(s.entry_idx.alias("entry_idx"),
                                    s.variant_idx.alias("variant_idx"),
                                    F.lit(name).alias("field"),
                                    s.source_text.alias("source_text"))
    fu = F.when(f.isNotNull(), unit(f, VARIANT_FIELDS[0]))
    mu = F.when(m.isNotNull(), unit(m, VARIANT_FIELDS[1]))
    units = g.select(
        *GROUP_KEY, F.col("first.entry_idx").alias("first_entry_idx"),
        is_dedup.alias("is_dedup"),
        F.explode(F.when(is_dedup, F.array(fu))
                   .otherwise(F.filter(F.array(fu, mu), lambda x: x.isNotNull()))).alias("u"))
    return units.select(*GROUP_KEY, "first_entry_idx", F.col("u.variant_idx").alias("variant_idx"),
                        F.col("u.field").alias("field"), F.col("u.entry_idx").alias("entry_idx"),
                        F.col("u.source_text").alias("source_text"), "is_dedup")


def plan_counts(pending: DataFrame, grouped: DataFrame | None = None) -> DataFrame:
    """A5: plan counters as metric rows (metric, value): pending entries, groups,
    deduped pairs, units to translate.  Both aggregates are single-row and map-side
    combined; the groups are not exploded to be counted."""
    g = grouped if grouped is not None else group_entries(pending)
    f, m = F.col("female"), F.col("male")
    dd = _is_dedup(f, m)
    n_units = F.when(dd, F.lit(1)).otherwise(f.isNotNull().cast("int") + m.isNotNull().cast("int"))
    per_group = g.agg(F.count(F.lit(1)).alias("n_groups"),
                      F.count_if(dd).alias("n_deduped"),
                      F.sum(n_units).alias("n_units"))
    n_pending = pending.agg(F.count(F.lit(1)).alias("value"))
    metrics = per_group.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value"))
        for c in ("n_groups", "n_deduped", "n_units")])).alias("m")).select("m.*")
    return n_pending.select(F.lit("n_pending").alias("metric"),
                            F.col("value").cast("long").alias("value")).unionByName(metrics)


def expand_dedup(records: DataFrame) -> DataFrame:
    """A translated female unit of a deduped group also yields the male record,
    with the same source and translated text, directly after the female one.
    ``variant_idx`` of the copy is 1, which keeps log order (O6)."""
    r = F.col
    fem = F.struct(r("variant_idx").alias("variant_idx"), r("field").alias("field"))
    male = F.struct(F.lit(1).alias("variant_idx"), F.lit(VARIANT_FIELDS[1]).alias("field"))
    out = records.withColumn(
        "_x", F.explode(F.when(r("is_dedup") & (r("field") == VARIANT_FIELDS[0]),
                               F.array(fem, male)).otherwise(F.array(fem))))
    return (out.withColumn("variant_idx", r("_x.variant_idx"))
               .withColumn("field", r("_x.field")).drop("_x"))


def key_collisions(entries: DataFrame) -> DataFrame:
    """(filepath, n_keys, n_entries) of entry keys that several entries of a file
    share: only the last one's text is sent, and every one of them gets its translation."""
    keys = normalize_ids(entries).groupBy(*ENTRY_KEY).agg(F.count(F.lit(1)).alias("n"))
    return keys.filter(F.col("n") > 1).groupBy("filepath").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_entries"))
