"""Shard placement by a permutation-filled lookup table.

Each shard orders the slots of a prime-sized table by its own permutation
``(offset + j * skip) mod size``; the shards take turns, each claiming its first free
slot, until the table is full.  Shares then differ by at most one slot, and adding or
removing a shard moves few slots.  The table depends on the shard names and its size
only, never on the data: a fixed ``size`` bounds what is broadcast.

A document's slot is the leading 60 bits of the MD5 of its key, modulo the table size.

Defined results: a null key is placed like the empty string; equal keys always share a
shard; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 64 shards on a table of 6,553 slots (prime, about 100 slots per shard).
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))
TABLE_SIZE = 6553


def _h60(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:15], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """Shard number per slot.  ``size`` must be a prime above the number of shards."""
    if not shards or size <= len(shards) or any(size % p == 0 for p in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table size must be a prime above the number of shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names must differ")
    at = [_h60(f"{s}#offset") % size for s in shards]
    skip = [_h60(f"{s}#skip") % (size - 1) + 1 for s in shards]
    table, left = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size).cast("int")


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS,
                size: int = TABLE_SIZE) -> DataFrame:
    """The lookup table as rows (slot, shard): ``size`` rows, whatever the data."""
    rows = [(slot, shards[i]) for slot, i in enumerate(lookup_table(shards, size))]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(df: DataFrame, key_col: str, shards: tuple[str, ...] = SHARDS,
          size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with ``slot`` and ``shard``: a broadcast hash join on the slot, no shuffle.
    Input columns named slot or shard are replaced."""
    base = df.drop(*[c for c in df.columns if c.lower() in ("slot", "shard") and c != key_col])
    placed = base.withColumn("__slot", slot_of(base[key_col], size))
    look = F.broadcast(table_frame(df.sparkSession, shards, size)
                       .select(F.col("slot").alias("__s"), F.col("shard").alias("__shard")))
    out = placed.join(look, placed["__slot"] == look["__s"]).drop("__s")
    if key_col.lower() in ("slot", "shard"):
        out = out.withColumnRenamed(key_col, f"{key_col}_key")
    return out.withColumnRenamed("__slot", "slot").withColumnRenamed("__shard", "shard")


def write_shards(df: DataFrame, path: str, key_col: str, shards: tuple[str, ...] = SHARDS,
                 size: int = TABLE_SIZE, files_per_shard: int = 8) -> None:
    """One folder per shard.  A salt splits a shard over ``files_per_shard`` tasks, so a
    shard with a hot key is not written by one task."""
    placed = place(df, key_col, shards, size)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard))
    (placed.withColumn("__salt", salt)
           .repartition("shard", "__salt").drop("__salt")
           .write.partitionBy("shard").mode("errorifexists").parquet(path))


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document with its slot and shard, placed by doc_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return place(docs, "doc_id")


#: The same fill in SQL: one recursion step per turn; ``taken`` is a bit string of slots.
ORACLE_SQL = f"""
with recursive shard as (
  select i, 'shard-' || lpad(cast(i as varchar), 3, '0') as name from range({len(SHARDS)}) r(i)
), perm as materialized (
  select i, name,
         cast(('0x' || substr(md5(name || '#offset'), 1, 15)) as bigint) % {TABLE_SIZE} as off,
         cast(('0x' || substr(md5(name || '#skip'), 1, 15)) as bigint) % {TABLE_SIZE - 1} + 1 as skip
  from shard
), pref as materialized (
  select i, list((off + j * skip) % {TABLE_SIZE} order by j) as slots
  from perm, range({TABLE_SIZE}) r(j) group by i
), fill as (
  select 0 as turn, cast(-1 as bigint) as slot, repeat('0', {TABLE_SIZE})::bit as taken
  union all
  select turn + 1, s, set_bit(taken, cast(s as int), 1)
  from (select f.turn, f.taken,
               list_filter(p.slots, lambda x: get_bit(f.taken, cast(x as int)) = 0)[1] as s
        from fill f join pref p on p.i = f.turn % {len(SHARDS)}
        where f.turn < {TABLE_SIZE})
)
select d.doc_id, f.slot::int as slot, 'shard-' || lpad(cast((f.turn - 1) % {len(SHARDS)} as varchar), 3, '0') as shard
from (select doc_id, cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15)) as bigint)
             % {TABLE_SIZE} as s from documents) d
join fill f on f.slot = d.s and f.turn > 0
"""
