"""Exact dedup with an extendible-hash index on shared files.

* every text gets a 64-bit hash; one narrow aggregation yields the distinct keys;
* the directory doubles (one more leading hash bit) while any bucket holds more than
  ``capacity`` distinct keys.  A bucket with few keys keeps a smaller local depth, so
  several directory slots point at it.  Keys and directory are tables in the shared
  checkpoint folder;
* a bucket owns a contiguous range of hash values.  Texts are grouped by (hash, bytes)
  with map-side aggregation, so a text that makes up a third of the corpus costs one
  row per map task.  The owner of a bucket then chains the distinct texts that collide
  on one hash (``chain`` = 0, 1, ...);
* documents probe the index by (hash, SHA-256, length).  Should two *different* texts
  of one chain ever agree on all three, the job fails instead of merging them.

Defined results: a null text counts as the empty text; an empty table gives an empty
result; repeated rows (same id and text) are copies of each other and all rows with the
largest id of a group are marked ``kept``; extra columns are ignored by
:func:`exact_dedup` and carried through by :func:`keep_one`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize

#: Distinct keys a bucket may hold before it splits.
CAPACITY = 4096
#: Bits of the directory at most: 2**MAX_DEPTH slots bound its size (and its broadcast).
MAX_DEPTH = 16


def _hash(text: Column, key_bits: int) -> Column:
    """64-bit hash of the text; fewer ``key_bits`` force collisions (tests)."""
    h = F.xxhash64(text)
    return h if key_bits == 64 else F.shiftleft(h, 64 - key_bits)


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def _keyed(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return (docs.select(docs[id_col].alias("id"), text.alias("body"))
                .withColumn("key", _hash(F.col("body"), key_bits)))


def build_directory(keys: DataFrame, capacity: int = CAPACITY,
                    max_depth: int = MAX_DEPTH) -> tuple[DataFrame, int]:
    """Directory of an extendible hash index over the distinct ``keys``.

    Returns (slot, bucket, local_depth) with 2**depth rows, and the global depth.
    ``bucket`` is the first slot of the bucket's range at ``max_depth`` bits, so bucket
    numbers order like the hash ranges they own.  At most 2**max_depth cell counts are
    aggregated per doubling; no key reaches the driver.
    """
    spark = keys.sparkSession
    cells = materialize(keys.groupBy(_prefix(F.col("key"), max_depth).alias("cell"))
                            .agg(F.count("*").alias("n")), "hash-cells")
    depth = 0
    while depth < max_depth:
        fullest = (cells.groupBy(F.shiftright("cell", max_depth - depth).alias("slot"))
                        .agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0])
        if (fullest or 0) <= capacity:
            break
        depth += 1  # the directory doubles
    # a slot's local depth: the shortest prefix whose bucket is not overfull
    levels = (cells.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"), "cell", "n")
                   .groupBy("d", F.expr(f"shiftright(cell, {max_depth} - d)").alias("p"))
                   .agg(F.sum("n").alias("n")))
    slots = spark.range(1 << depth).withColumnRenamed("id", "slot")
    walk = slots.select("slot", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d")) \
                .withColumn("p", F.expr(f"shiftright(slot, {depth} - d)"))
    local = (walk.join(levels, ["d", "p"], "left")
                 .groupBy("slot")
                 .agg(F.min(F.when(F.coalesce("n", F.lit(0)) <= capacity, F.col("d")))
                       .alias("fit")))
    directory = (local.select("slot", F.coalesce("fit", F.lit(depth)).alias("local_depth"))
                 .withColumn("bucket", F.expr(
                     f"shiftleft(shiftright(slot, {depth} - local_depth), "
                     f"{max_depth} - local_depth)")))
    return materialize(directory, "hash-directory"), depth


def _owned(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """Each row's bucket: one lookup by the leading ``depth`` hash bits.  The directory
    has at most 2**MAX_DEPTH narrow rows, so broadcasting it is bounded."""
    look = F.broadcast(directory.select("slot", "bucket"))
    return (rows.withColumn("slot", _prefix(F.col("key"), depth))
                .join(look, "slot", "left").drop("slot"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
                key_bits: int = 64) -> DataFrame:
    """Index entries, one row per distinct text: bucket, key, chain, sha (hex),
    n_bytes, keep_id (largest id), group_size."""
    keyed = _keyed(docs, id_col, text_col, key_bits)
    keys = materialize(keyed.groupBy("key").agg(F.count("*").alias("n_rows")), "hash-keys")
    directory, depth = build_directory(keys, capacity, max_depth)
    # byte comparison: texts group by their own bytes, copies collapse before the shuffle
    texts = (keyed.groupBy("key", "body")
                  .agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
                  .select("key", F.sha2("body", 256).alias("sha"),
                          F.octet_length("body").alias("n_bytes"), "keep_id", "group_size"))
    owned = _owned(texts, directory, depth)
    chain = W.partitionBy("bucket", "key").orderBy("sha", "n_bytes", F.desc("group_size"))
    same = W.partitionBy("bucket", "key", "sha", "n_bytes")
    return (owned.withColumn("chain", F.row_number().over(chain) - 1)
                 .withColumn("twins", F.count("*").over(same)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, max_depth: int = MAX_DEPTH,
                key_bits: int = 64) -> DataFrame:
    """One row per input row: <id>, keep_id, group_size, kept, text_sha256, bucket, chain."""
    index = build_index(docs, id_col, text_col, capacity, max_depth, key_bits)
    index = index.withColumn("keep_id", F.when(
        F.col("twins") > 1,
        F.raise_error(F.lit("two different texts share hash, SHA-256 and length")).cast("long"))
        .otherwise(F.col("keep_id"))).drop("twins")
    probes = (_keyed(docs, id_col, text_col, key_bits)
              .select("id", "key", F.sha2("body", 256).alias("sha"),
                      F.octet_length("body").alias("n_bytes")))
    # AQE splits the probe side of a hot key; the index side has one row per text
    out = probes.join(index, ["key", "sha", "n_bytes"])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.col("sha").alias("text_sha256"), "bucket", "chain")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    Only (id, SHA-256) pairs of dropped rows are joined back, so a small set of copies is
    broadcast by Spark and the texts are not shuffled.  Repeated rows of one document
    (same id, same text) collapse into one."""
    verdict = materialize(exact_dedup(docs, id_col, text_col)
                          .select(F.col(id_col).alias("__id"), "kept",
                                  F.col("text_sha256").alias("__sha")), "dedup-verdict")
    again = (verdict.filter("kept").groupBy("__id", "__sha").agg(F.count("*").alias("n"))
                    .filter("n > 1").select("__id", "__sha"))
    again = materialize(again, "dedup-repeated")
    leave = materialize(verdict.filter(~F.col("kept")).select("__id", "__sha").distinct()
                        .unionByName(again), "dedup-dropped")
    names = docs.columns
    sha = F.sha2(F.coalesce(docs[text_col].cast("string"), F.lit("")), 256)
    keyed = docs.withColumn("__doc_sha", sha)

    def match(side):
        return (keyed[id_col].eqNullSafe(side["__id"])) & (keyed["__doc_sha"] == side["__sha"])

    once = keyed.join(leave, match(leave), "left_anti")
    repeated = keyed.join(again, match(again), "left_semi").dropDuplicates([id_col, "__doc_sha"])
    return once.unionByName(repeated).select(*names)


def op4_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with the row that stays of its group of equal texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE_SQL = """
select doc_id, max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept,
       sha256(t) as text_sha256
from (select doc_id, coalesce(text, '') as t from documents)
"""
