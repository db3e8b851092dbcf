"""Document fingerprints: weighted SimHash over word shingles, and the search within a
Hamming radius by permuted block tables.

Every occurrence of a five-word shingle votes with weight 1 on each bit of its 128-bit
hash (so a term's weight is its count); a bit of the fingerprint is set when more weight
voted for it than against it.  Two bits share one 64-bit sum (two lanes of 32 bits), so
one aggregate of 64 sums, combined before the shuffle, makes a fingerprint; it is exact up
to 2**32 shingles a text.  The expected share of equal bits of two texts is
1 - angle / pi of their shingle count vectors.

The next document by id: ids are cut at exact quantiles into ranges of bounded text
volume.  A document goes to its range, the first of a range also to the one before, and
each range finds successors by a window of its own: one shuffle of the texts, no global
sort in one task.

Defined results: a null text counts as empty; the fingerprint of a text without words is
all zeros; fewer than five words are one shingle; rows with equal ids follow each other by
text, a null id comes first; a single document is its own successor; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize

WIDTH = 5
#: Bytes of text per range, and ranges at most (they bound the list of cut points).
RANGE_BYTES, MAX_RANGES = 8 << 20, 4096
_SPACE = r"[\x20\x09-\x0D]+"
_LANES = 0x0000000100000001
_LOW = 0xFFFFFFFF


def _word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), _SPACE), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _votes(rows: DataFrame, keys: list[str], words: str) -> DataFrame:
    """keys, fp (32 hex digits): one fingerprint per key over the word hashes."""
    n = F.size(words)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0))))
    at = rows.select(*keys, words, F.explode_outer(starts).alias("i"))
    parts = [F.get(F.col(words), F.col("i") + j) for j in range(WIDTH)]
    some = F.col("i").isNotNull()
    h = at.select(*keys, F.when(some, F.xxhash64(*parts)).alias("h0"),
                  F.when(some, F.xxhash64(F.lit(1), *parts)).alias("h1"))
    sums = [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_LANES))).alias(f"{h}_{i}")
            for h in ("h0", "h1") for i in range(32)]
    voted = h.groupBy(*keys).agg(F.count("h0").alias("n"), *sums)

    def half(hash_name: str) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            both = F.coalesce(F.col(f"{hash_name}_{i}"), F.lit(0).cast("long"))
            low, high = both.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(both, 32)
            out = out.bitwiseOR(F.when(low * 2 > F.col("n"), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
            bit = 1 << (i + 32)
            bit = bit - (1 << 64) if bit >= 1 << 63 else bit
            out = out.bitwiseOR(F.when(high * 2 > F.col("n"), F.lit(bit).cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    return voted.select(*keys, half("h0").alias("f0"), half("h1").alias("f1"))


def _hex(f0: Column, f1: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f0), 16, "0"), F.lpad(F.hex(f1), 16, "0")))


def _likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    differ = F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))
    return 1 - differ / 128


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """<id>, f0, f1, fingerprint (hex) of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col),
                       _word_hashes(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("words"))
    out = _votes(rows, ["row", id_col], "words")
    return out.select(id_col, "f0", "f1", _hex(F.col("f0"), F.col("f1")).alias("fingerprint"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3, table_blocks: int = 2) -> DataFrame:
    """Pairs (q, p, distance) of distinct fingerprints at most ``radius`` bits apart.

    ``prints`` and ``queries`` hold (f0, f1).  The 128 bits are cut into ``radius +
    table_blocks`` blocks; two fingerprints within the radius agree on at least
    ``table_blocks`` of them.  Each choice of that many blocks is a table keyed by their
    bits, i.e. a permutation that brings them to the front.  Equal fingerprints are one
    entry, so copies make no pairs; members are found by joining on the fingerprint."""
    n = radius + table_blocks
    edges = [round(128 * i / n) for i in range(n + 1)]

    def block(lo: int, hi: int) -> Column:
        """Bits lo to hi - 1 of f0 (0 to 63) and f1 (64 to 127)."""
        def cut(name, a, b):
            width = b - a
            v = F.shiftrightunsigned(F.col(name), a)
            return v if width == 64 else v.bitwiseAND(F.lit((1 << width) - 1))
        parts = []
        if lo < 64:
            parts.append(cut("f0", lo, min(hi, 64)))
        if hi > 64:
            parts.append(cut("f1", max(lo, 64) - 64, hi - 64))
        return F.concat_ws(":", *parts)

    blocks = [block(a, b) for a, b in zip(edges, edges[1:])]
    tables = F.array(*[F.concat_ws("|", F.lit(",".join(map(str, c))), *[blocks[i] for i in c])
                       for c in combinations(range(n), table_blocks)])

    def keyed(df, tag):
        one = df.select("f0", "f1").distinct().withColumn("key", F.explode(tables))
        return one.select("key", F.col("f0").alias(f"{tag}0"), F.col("f1").alias(f"{tag}1"))

    pairs = keyed(queries, "q").join(keyed(prints, "p"), "key")
    differ = F.bit_count(F.col("q0").bitwiseXOR(F.col("p0"))) + F.bit_count(F.col("q1").bitwiseXOR(F.col("p1")))
    near = pairs.withColumn("distance", differ).filter((F.col("distance") <= radius) & (F.col("distance") > 0))
    return near.select(_hex(F.col("q0"), F.col("q1")).alias("q"), _hex(F.col("p0"), F.col("p1")).alias("p"),
                       "distance").distinct()


def with_successor(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """range, pos, tail, id, t, next_t: each document with its successor's text.  Rows with
    ``tail`` are the copies of the next range's first document."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    size, least = rows.agg(F.sum(F.octet_length("t")), F.min("id")).first()
    n = max(1, min(MAX_RANGES, -(-int(size or 0) // RANGE_BYTES)))
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)] or [0.5], 10 * MAX_RANGES)).first()[0] if n > 1 else None
    cuts = sorted({least, *(cuts or [])}) if least is not None else [0]
    cut_list = F.array(*[F.lit(c) for c in cuts])
    # rows before the first cut (null ids) belong to the first range
    own = F.greatest(F.size(F.filter(cut_list, lambda c: c <= F.coalesce(F.col("id"), F.lit(cuts[0])))) - 1, F.lit(0))
    head = F.when(F.array_contains(cut_list, F.col("id")), F.pmod(own - 1, F.lit(len(cuts))))
    first = F.when(F.col("id").isNull(), F.lit(len(cuts) - 1)).otherwise(head)
    spread = rows.withColumn("to", F.explode(F.array(
        F.struct(own.alias("range"), F.lit(False).alias("tail")),
        F.struct(first.alias("range"), F.lit(True).alias("tail"))))) \
        .select("to.range", "to.tail", "id", "t").filter("range is not null")
    w = W.partitionBy("range").orderBy("tail", "id", "t")
    return (spread.repartition("range")
                  .withColumns({"pos": F.row_number().over(w), "next_t": F.lead("t").over(w)}))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: <id>, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  The edited text has the last floor(n_chars / 2) code points
    replaced by the first as many of the next document."""
    rows = with_successor(docs, id_col, text_col)
    half = F.floor(F.length("t") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.expr("substring(t, 1, length(t) - cast(floor(length(t) / 2) as int))"),
                                              F.substr(F.coalesce("next_t", F.lit("")), F.lit(1), half)))
    both = rows.select(
        "range", "pos", "tail", "id", F.length("t").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("sha"),
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("t").alias("body")),
                          F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).alias("v"))
    keys = ["range", "pos", "tail", "id", "n_chars", "sha", "kind"]
    hashed = both.filter("not tail or v.kind = 0").select(
        *keys[:-1], F.col("v.kind").alias("kind"), _word_hashes(F.col("v.body")).alias("words"))
    prints = _votes(hashed, keys, "words")

    def of(kind, name):
        return F.max(F.when(F.col("kind") == kind, F.col(name)))

    docs_ = prints.groupBy(*keys[:-1]).agg(of(0, "f0").alias("f0"), of(0, "f1").alias("f1"),
                                           of(1, "f0").alias("e0"), of(1, "f1").alias("e1"))
    w = W.partitionBy("range").orderBy("pos")
    docs_ = docs_.withColumns({"x0": F.lead("f0").over(w), "x1": F.lead("f1").over(w)}).filter(~F.col("tail"))
    c = F.col
    return docs_.select(
        c("id").alias(id_col), "n_chars", c("sha").alias("edited_sha256"),
        _hex(c("f0"), c("f1")).alias("fingerprint"), _hex(c("e0"), c("e1")).alias("edited_fingerprint"),
        _likeness((c("f0"), c("f1")), (c("e0"), c("e1"))).alias("near_edited"),
        _likeness((c("f0"), c("f1")), (c("x0"), c("x1"))).alias("near_next"))


def near_counts(prints: DataFrame, queries: Column, radius: int = 3) -> DataFrame:
    """``prints`` (with fingerprint) and near_prints: for rows that meet ``queries`` the number
    of other distinct fingerprints at most ``radius`` bits away among all rows, else null."""
    def half(start: int) -> Column:
        return F.conv(F.substr("fingerprint", F.lit(start), F.lit(16)), 16, -10).cast("long")

    asked = F.coalesce(queries, F.lit(False))
    both = [df.select(half(1).alias("f0"), half(17).alias("f1")) for df in (prints, prints.filter(asked))]
    found = within_radius(*both, radius).groupBy("q").agg(F.count("*").alias("found"))
    rows = prints.join(found, F.col("fingerprint") == F.col("q"), "left")
    return rows.select(*prints.columns, F.when(asked, F.coalesce("found", F.lit(0).cast("long"))).alias("near_prints"))


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; for ids divisible by 20 also the
    number of other fingerprints of the table within three bits, by permuted block tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    prints = materialize(edited_fingerprints(docs), "fingerprints")
    return near_counts(prints, F.col("doc_id") % 20 == 0)
