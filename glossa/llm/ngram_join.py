"""Self-join of documents on the Jaccard similarity of their word shingles, with PartEnum
signatures, down to one component id per document.

Two documents link when ``100 * |A & B| >= percent * |A | B|``.

**Classes.**  Documents with equal sets are one class, so copies never meet as pairs.

**Signatures.**  Sizes are cut into overlapping bands such that any two sizes that can
link share a band.  In each of its bands a set of n elements splits the feature domain
into equal parts.  Linked sets of sizes a <= b differ in at most
``d = (a + b)(100 - percent) / (100 + percent)`` elements, hence in at most d parts, and
d <= k(n) whichever of the two n is.

* Small bands enumerate all subsets of parts that leave out the most that may differ.
* Larger bands enumerate the single parts.  Of the m non-empty parts of linked sets at
  least m - d agree, so two sets already share one of their k + 1 first parts in any
  common order.  The order goes by the corpus-wide frequency of a part's rarest shingle,
  so a line or passage that many documents share makes no candidates by itself.  Sets of
  more than SKETCH_BITS elements emit some parts beyond k + 1, which raises the number a
  linked pair must share.
* A set that runs out of rare parts emits frequent ones, too, and then each of its rare
  shingles alone.  Two such sets either meet in a rare shingle, or share none, and then
  they differ in all r rare shingles of both: their frequent signatures count only if
  r_a + r_b <= d.  So documents around a common passage are not compared with each other
  unless nearly all they hold is common.
* A set with at most k non-empty parts also emits its band's "few parts" signature.

**Pairs.**  Sets that share a signature are checked against the least set of the group,
each set only against the leader it shares most with, not all against all.  Links give
components.  Then only groups that still hold several components are searched on.  Those of
more than ``CROWD`` sets first check each set against HEADS members drawn by chance, alike in
all groups, so that a group of near copies whose least set is unlike the others becomes one
component before its pairs are formed.  Then come all pairs between components in groups up
to ``GROUP``, LEADERS members (of the smallest components) per round in larger ones, until no
group is left.  Groups with the same members (the parts of one shared passage) are searched
once, and a set that has fewer open signatures than a linked pair must share makes no pair.

**Sketches.**  A class carries one bit per hash bucket: whether the set has an odd number of
elements in it.  Two sets differ in at least as many elements as their sketches differ in
bits, so a pair whose sketches differ in more than d bits cannot link.  The test is part of
the join condition of a group's members: only pairs that pass it become rows, and only
their texts move.  Every candidate left is verified on whole texts, so the order, the
leaders, the sketches and the frequency table decide cost only, never the result.

Frequent shingles are counted over all documents: each task counts its own and passes on
those above a floor.  Frequency classes and documents to verify travel as tables of fixed
size.

Defined results: null, empty and blank texts have the empty set, link with nothing and
are their own component; equal sets link; repeated rows repeat in the result; an empty
table gives an empty result; extra columns are ignored by :func:`link_documents` and kept
by :func:`keep_one_per_group`.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import few_rows_at_once, materialize
from .shingles import WIDTH, mix, shingle_sets

PERCENT = 75
#: Small band: sizes up to SMALL, cut into SMALL_PARTS parts.  Larger bands end at
#: STRETCH times their start, with as many parts as the largest size.
SMALL, SMALL_PARTS, STRETCH = 11, 5, 4
#: Groups up to this size are searched in full; larger ones by LEADERS a round.
GROUP, LEADERS = 512, 512
#: Larger groups are thinned by HEADS members each before their pairs are searched.
CROWD, HEADS = 16, 8
#: Bits of a set's parity sketch, in longs of 64.
SKETCH_BITS = 512
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: A task passes on shingles that it met this often among COUNTED elements; a shingle is
#: frequent from FREQUENT on.  At most MOST_FREQUENT enter the table (else FREQUENT doubles).
LOCAL_FLOOR, COUNTED, FREQUENT, MOST_FREQUENT = 8, 2_000_000, 32, 1 << 18
BITMAP_BITS = 22
#: Documents to verify up to this number are picked by a broadcast of their ids, more by
#: a bitmap.
FEW_IDS = 100_000


def allowance(n: int, percent: int = PERCENT) -> int:
    """k(n): elements that a set of n elements and any set linked to it may differ in."""
    # the partner has at most 100 n / percent elements
    return n * (100 - percent) // percent


def bands(largest: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(first size, last size, parts); sets of fewer than 3 elements link only if equal
    (for percent >= 75), so the first band starts at 3."""
    out = [(3, SMALL, SMALL_PARTS)]
    while out[-1][1] < largest:
        first = -(-percent * (out[-1][1] + 1) // 100)
        out.append((first, STRETCH * first, STRETCH * first))
    return out


#: "slack" of a signature that any two sets may meet in.
FREE = -(1 << 40)
_BANDS = bands(1 << 40)
_SUBSETS = list(combinations(range(SMALL_PARTS), SMALL_PARTS - allowance(SMALL)))


def _parts(s: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-empty parts of a sorted set: (part numbers, position of their first element).
    A part is a range of hashes, so the elements of a part stand together."""
    p = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
    return p[first].astype(np.int64), first


def emitted(n: int, m: int) -> int:
    """Signatures of a set of n elements with m non-empty parts in a larger band."""
    more = n // 16 if n > SKETCH_BITS else 0  # smaller sets are told apart by their sketches
    return min(m, allowance(n) + 1 + more)


def signatures(s: np.ndarray, level: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of one set, and their slack: two sets need to meet in a signature only
    if their slacks add up to 0 at most.  ``level``: frequency class per element, 0 rare."""
    n, out, slack = s.size, [], []

    def emit(sig, w=FREE):
        out.append(sig)
        slack.append(np.broadcast_to(np.int64(w), sig.shape) if np.isscalar(w) else w)

    for b, (first, last, parts) in enumerate(_BANDS):
        if first > n:
            break
        if n > last:
            continue
        numbers, at = _parts(s, parts)
        content = np.add.reduceat(mix(s), at)
        salt = mix(np.array([b + 1], np.uint64))
        if parts == SMALL_PARTS:
            whole = np.zeros(parts, np.uint64)
            whole[numbers] = content
            full = np.zeros(parts, bool)
            full[numbers] = True
            for i, c in enumerate(_SUBSETS):
                if full[list(c)].any():
                    emit(mix(mix(whole[list(c)].sum(keepdims=True, dtype=np.uint64)) + salt + np.uint64(i)))
        else:
            sig = mix(content + salt)
            common = np.minimum.reduceat(level, at)
            order = np.lexsort((sig, common))[:emitted(n, len(at))]
            hot = common[order] > 0
            rare = s[level == 0]
            emit(sig[order], np.where(hot, (100 + percent) * rare.size - (100 - percent) * n, FREE).astype(np.int64))
            if hot.any() and rare.size:
                emit(mix(mix(rare) + salt))
        if len(at) <= allowance(n):
            emit(mix(salt))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(slack)


def _least_emitted(s: np.ndarray) -> int:
    """The fewest single-part signatures of the set over its bands; -1 where the small
    band takes part, whose subsets say nothing about the number of shared parts."""
    n, least = s.size, -1
    for first, last, parts in _BANDS:
        if first <= n <= last:
            if parts == SMALL_PARTS:
                return -1
            m = emitted(n, len(_parts(s, parts)[0]))
            least = m if least < 0 else min(least, m)
    return least


def _hot_slack(s: np.ndarray, level: np.ndarray, percent: int = PERCENT) -> int:
    """The slack of the frequent signatures that the set emits; FREE if it emits none."""
    n = s.size
    for first, last, parts in _BANDS:
        if first <= n <= last and parts != SMALL_PARTS:
            at = _parts(s, parts)[1]
            if (np.minimum.reduceat(level, at) == 0).sum() < emitted(n, len(at)):
                return (100 + percent) * int((level == 0).sum()) - (100 - percent) * n
    return FREE


def _set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a = mix(mix(s).sum(keepdims=True, dtype=np.uint64) + np.uint64(s.size))
    b = mix(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True, dtype=np.uint64))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """SKETCH_BITS bits as longs: the parity of the number of elements in each hash bucket."""
    bucket = ((s >> np.uint64(16)) & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    odd = (np.bincount(bucket, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


# -- bitmaps of fixed size --------------------------------------------------------------------
def _bitmap(rows: DataFrame, col: str) -> np.ndarray:
    """Bitmap of 2**BITMAP_BITS bits over the low bits of a long column, or-ed together on
    the executors; the driver gets at most 2**(BITMAP_BITS - 6) rows."""
    low = F.col(col).bitwiseAND((1 << BITMAP_BITS) - 1)
    words = (rows.select(F.shiftright(low, 6).alias("w"),
                         F.expr(f"shiftleft(1L, cast({col} & 63 as int))").alias("bit"))
                 .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[np.asarray(words.column("w"))] = np.asarray(words.column("bits")).view(np.uint64)
    return out


def _in_bitmap(bitmap: np.ndarray, v: np.ndarray) -> np.ndarray:
    low = v & np.uint64((1 << BITMAP_BITS) - 1)
    return (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


# -- passes over the texts --------------------------------------------------------------------
def set_keys(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """id -> n (set size), key, key2, least (see _least_emitted), hot (see _hot_slack) and the
    sketch."""
    kind = dict(docs.dtypes)["id"]
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2**BITMAP_BITS bytes

    def run(batches):
        for batch in batches:
            n, k1, k2, least, hot, bits = [], [], [], [], [], [np.zeros((0, len(SKETCH)), np.int64)]
            for s in shingle_sets(batch.column(1).to_pylist()):
                a, b = _set_key(s)
                n.append(s.size)
                k1.append(a)
                k2.append(b)
                least.append(_least_emitted(s))
                level = shared.value[(s & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)]
                hot.append(_hot_slack(s, level, percent))
                bits.append(parity_sketch(s)[None])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, k1, k2, least, hot, *np.concatenate(bits).T))],
                names=["id", "n", "key", "key2", "least", "hot", *SKETCH])

    return docs.select("id", "text").mapInArrow(
        run, f"id {kind}, " + ", ".join(f"{c} bigint" for c in ("n", "key", "key2", "least", "hot", *SKETCH)))


def _distinct_sets(batches, column: int):
    """Sets of at least 3 elements, without those that repeat within the task's last 100,000."""
    seen: set = set()
    for batch in batches:
        for s in shingle_sets(batch.column(column).to_pylist()):
            if s.size < 3:
                continue
            key = _set_key(s)
            if key not in seen:
                if len(seen) >= 100_000:
                    seen.clear()
                seen.add(key)
                yield key[0], s


def frequency_levels(docs: DataFrame) -> np.ndarray:
    """Frequency class of a shingle by its low BITMAP_BITS bits: 0 rare, then one more for
    each doubling of its count.  A rare shingle that shares the bits of a frequent one
    counts as frequent everywhere, which costs little and changes no result."""
    def counted(parts):
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        often = n >= LOCAL_FLOOR
        return pa.RecordBatch.from_arrays(
            [pa.array(h[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=["h", "n"])

    def run(batches):
        parts, size = [], 0
        for _, s in _distinct_sets(batches, 0):
            parts.append(s)
            size += s.size
            if size >= COUNTED:
                yield counted(parts)
                parts, size = [], 0
        if parts:
            yield counted(parts)

    totals = materialize(docs.select("text").mapInArrow(run, "h bigint, n bigint")
                         .groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT), "frequent")
    floor = FREQUENT
    while totals.filter(F.col("n") >= floor).count() > MOST_FREQUENT:
        floor *= 2
    rows = (totals.filter(F.col("n") >= floor)
                  .groupBy(F.col("h").bitwiseAND((1 << BITMAP_BITS) - 1).alias("low"))
                  .agg((F.floor(F.log2(F.max("n") / floor)) + 1).cast("int").alias("level")).toArrow())
    out = np.zeros(1 << BITMAP_BITS, np.uint8)
    out[np.asarray(rows.column("low"))] = np.asarray(rows.column("level"))
    return out


def postings(docs: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """(sig, slack, key) rows: the signatures of every set."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)  # 2**BITMAP_BITS bytes

    def listed(keys, sigs, slack):
        offsets = pa.array(np.append(0, np.cumsum([x.size for x in sigs])).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), *(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x)))
                                           for x in (sigs, slack))], names=["key", "sigs", "slack"])

    def run(batches):
        keys, sigs, slack, size = [], [], [], 0
        for key, s in _distinct_sets(batches, 0):
            level = shared.value[(s & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)]
            sig, w = signatures(s, level, percent)
            keys.append(key)
            sigs.append(sig.view(np.int64))
            slack.append(w)
            size += sig.size
            if size >= 100_000:
                yield listed(keys, sigs, slack)
                keys, sigs, slack, size = [], [], [], 0
        if keys:
            yield listed(keys, sigs, slack)

    rows = docs.select("text").mapInArrow(run, "key bigint, sigs array<bigint>, slack array<bigint>")
    return rows.select("key", F.explode(F.arrays_zip("sigs", "slack")).alias("s")) \
               .select(F.col("s.sigs").alias("sig"), F.col("s.slack").alias("slack"), "key")


def verify(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of the pairs (a, b) of representatives' ids, those whose whole texts link.

    The texts of other documents are left out before the shuffle: by a broadcast of the
    ids when these are counted to be few, else by a bitmap of fixed size.  Each text
    travels to its pairs; a leader's text is read once per task by the sort order."""
    kind = dict(docs.dtypes)["id"]
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "verify-ids")
    if ids.count() <= FEW_IDS:
        texts = docs.select("id", "text").join(F.broadcast(ids), "id", "left_semi")
    else:
        wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(ids.select(F.xxhash64("id").alias("h")), "h"))

        def run_filter(batches):
            for batch in batches:
                yield batch.filter(pa.array(_in_bitmap(wanted.value, np.asarray(batch.column(2)).view(np.uint64))))

        texts = (docs.select("id", "text", F.xxhash64("id").alias("h"))
                     .mapInArrow(run_filter, f"id {kind}, text string, h bigint").drop("h"))
    left = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    both = left.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")

    def run(batches):
        last, cached = None, None
        for batch in batches:
            a, ta, tb = (batch.column(i) for i in (0, 2, 3))
            keep = []
            for i, s in enumerate(shingle_sets(tb.to_pylist())):
                if cached is None or a[i] != last:
                    last, cached = a[i], next(shingle_sets([ta[i].as_py()]))
                common = np.intersect1d(s, cached, assume_unique=True).size
                keep.append(100 * common >= percent * (s.size + cached.size - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]) \
                .filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(run, f"a {kind}, b {kind}")


# -- components -------------------------------------------------------------------------------
def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the least id reachable over the edges (a, b), for every id in an edge.

    Each round takes the least label among the neighbours (an aggregate, combined before
    the shuffle), then follows the label's own label.  Every round is a written table."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
                            .distinct(), "component-edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b"))
                             .select("id", F.least("id", "b").alias("comp")), "component-labels")
    while True:
        seen = (both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id"))
                    .agg(F.min("comp").alias("near")))
        near = labels.join(seen, "id").select("id", "comp", F.least("comp", "near").alias("now"))
        up = labels.select(F.col("id").alias("now"), F.col("comp").alias("up"))
        step = materialize(near.join(up, "now").select("id", F.col("comp").alias("was"),
                                                       F.least("now", "up").alias("comp")), "component-labels")
        labels = step.select("id", "comp")
        if step.filter("was != comp").isEmpty():
            return labels


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


# -- the join ---------------------------------------------------------------------------------
def _classes(keys: DataFrame) -> DataFrame:
    return materialize(keys.filter("n > 0").groupBy("n", "key", "key2")
                       .agg(F.min("id").alias("rep"), F.max("least").alias("least"), F.max("hot").alias("hot"),
                            *(F.min(s).alias(s) for s in SKETCH)), "set-classes")  # equal sets, equal sketches


def _differ(percent: int) -> Column:
    """d: elements that linked sets of na and nb elements differ in at most."""
    return F.floor((F.col("na") + F.col("nb")) * (100 - percent) / (100 + percent))


def _may_link(percent: int) -> Column:
    """Whether the sizes na, nb and the sketches (a_s0.., b_s0..) allow a link."""
    bits = sum((F.bit_count(F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))) for s in SKETCH[1:]),
               F.bit_count(F.col(f"a_{SKETCH[0]}").bitwiseXOR(F.col(f"b_{SKETCH[0]}"))))
    return (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & (bits <= _differ(percent))


def _sketch_as(side: str) -> list[Column]:
    return [F.col("n").alias(f"n{side}"), *(F.col(s).alias(f"{side}_{s}") for s in SKETCH)]


def _with_ids(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Key pairs (ka, kb) as representatives (a, b) whose sizes and sketches allow a link."""
    c = classes.filter("n >= 3")
    a = c.select(F.col("key").alias("ka"), F.col("rep").alias("a"), F.col("least").alias("la"),
                 F.col("hot").alias("ha"), *_sketch_as("a"))
    b = c.select(F.col("key").alias("kb"), F.col("rep").alias("b"), F.col("least").alias("lb"),
                 F.col("hot").alias("hb"), *_sketch_as("b"))
    return pairs.join(a, "ka").join(b, "kb").filter(_may_link(percent)) \
                .drop(*(f"{side}_{s}" for side in "ab" for s in SKETCH))


def _enough(percent: int, c: Column | None = None) -> Column:
    """Whether two sets that meet in ``c`` signatures (or fewer) may link, by their sizes.

    Where both fall back to frequent parts and their slacks add up to more than 0, the
    frequent parts that they share are no meetings.  Linked sets with r_a and r_b rare
    shingles then meet in each rare one they share, (r_a + r_b - d) / 2 at least."""
    c = F.col("c") if c is None else c
    differ = _differ(percent)
    slack = F.col("ha") + F.col("hb")
    rare = (slack > 0) & (2 * (100 + percent) * c >= slack)
    return (F.least("la", "lb") < 0) | (c >= F.least("la", "lb") - differ) | rare


def _residual(groups: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Signature groups that still hold several components: (sig, slack, key, comp, members,
    times).  Sets that may meet nobody in their group by their slack are left out.  Of groups
    with the same members one stays, with their number as ``times``; the members are told
    apart by 128 bits over all of them."""
    comp = classes.filter("n >= 3").select("key", "rep") \
                  .join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    # keys that two classes share (a hash collision) stay apart: they have two rows here
    rows = groups.join(comp.select("key", F.coalesce("comp", "rep").alias("comp")), "key")
    least = rows.groupBy("sig").agg(F.min("slack").alias("least"), F.min("comp").alias("lo"),
                                    F.max("comp").alias("hi")).filter("lo != hi and least <= 0")
    rows = rows.join(least.select("sig", "least"), "sig").filter("slack + least <= 0")
    by = rows.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                 F.count("*").alias("members"), F.bit_xor(F.xxhash64("key", "slack", "comp")).alias("h1"),
                                 F.bit_xor(F.xxhash64("comp", "slack", "key")).alias("h2")).filter("lo != hi")
    one = by.groupBy("members", "h1", "h2").agg(F.min("sig").alias("sig"), F.count("*").alias("times"))
    return rows.join(one.select("sig", "members", "times"), "sig") \
               .select("sig", "slack", "key", "comp", "members", "times")


def _crowded(rest: DataFrame) -> DataFrame:
    """(ka, kb, c): the sets of crowded groups with those of their HEADS members that are in
    other components, and the signatures (of these groups) that they meet in; of each set
    with the HEADS that it meets most."""
    crowd = rest.filter(F.col("members") > CROWD)
    head = [F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("h"), "key", "slack", "comp")) for i in range(HEADS)]
    heads = crowd.groupBy("sig").agg(*(x.alias(f"h{i}") for i, x in enumerate(head))) \
                 .select("sig", F.array_distinct(F.array(*(
                     F.struct(*(F.col(f"h{i}.{c}").alias(c) for c in ("key", "slack", "comp"))) for i in range(HEADS)))).alias("heads"))
    met = crowd.join(heads, "sig") \
               .withColumn("heads", F.expr("filter(heads, h -> h.comp != comp and h.key != key and h.slack + slack <= 0)")) \
               .select("key", "times", F.explode("heads.key").alias("head"))
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("c"), "head"))
    return met.groupBy("key", "head").agg(F.sum("times").alias("c")) \
              .withColumn("r", rank).filter(F.col("r") <= HEADS) \
              .groupBy(F.least("key", "head").alias("ka"), F.greatest("key", "head").alias("kb")).agg(F.max("c").alias("c"))


def _relabelled(rest: DataFrame, labels: DataFrame) -> DataFrame:
    """The open groups with the components of ``labels``, without those that hold one only."""
    rows = rest.join(labels.select(F.col("id").alias("comp"), F.col("comp").alias("now")), "comp", "left") \
               .withColumn("comp", F.coalesce("now", "comp")).select(*rest.columns)
    several = rows.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi")
    return rows.join(several.select("sig"), "sig", "left_semi")


def similar_classes(docs: DataFrame, classes: DataFrame, levels: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """(id, comp) of the class representatives that link with another class."""
    found = postings(docs, levels, percent)
    by_sig = W.partitionBy("sig")
    groups = (found.withColumns({"lead": F.min(F.struct("slack", "key")).over(by_sig),
                                 "low": F.min("key").over(by_sig), "top": F.max("key").over(by_sig)})
                   .filter("low != top and slack + lead.slack <= 0")
                   .select("sig", "slack", "key", F.col("lead.key").alias("lead")))
    groups = materialize(groups, "signature-groups")
    # first against the leader that a set shares most signatures with
    shared = (groups.filter("key != lead").groupBy("lead", "key").agg(F.count("*").alias("c")))
    best = shared.groupBy("key").agg(F.max(F.struct("c", "lead")).alias("m"))
    first = _with_ids(best.select(F.col("m.lead").alias("ka"), F.col("key").alias("kb"), F.col("m.c").alias("c")),
                      classes, percent).filter(_enough(percent))  # the others are left to the rounds below
    first = materialize(_oriented(first).distinct(), "pairs")
    edges = materialize(_oriented(verify(first, docs, percent)), "links")
    done = first.select("a", "b")  # pairs already verified, linked or not
    counts_whole = True
    groups = groups.groupBy("sig", "key").agg(F.min("slack").alias("slack"))
    labels = components(edges)
    traits = classes.filter("n >= 3").select("key", "n", "least", "hot", *SKETCH)

    def side(rows: DataFrame, x: str, *more: str) -> DataFrame:
        return rows.join(traits, "key").select(
            "sig", F.col("key").alias(f"k{x}"), F.col("comp").alias(f"c{x}"), F.col("slack").alias(f"w{x}"),
            F.col("least").alias(f"l{x}"), F.col("hot").alias(f"h{x}"), F.col("own").alias(f"own{x}"), *more, *_sketch_as(x))

    def check(pairs: DataFrame) -> bool:
        """Verify the pairs that are not yet verified; whether any of them links."""
        nonlocal done, edges, labels
        pairs = materialize(_oriented(pairs).distinct().join(done, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            return False
        more = materialize(_oriented(verify(pairs, docs, percent)), "links")
        done = done.unionByName(pairs)
        if more.isEmpty():
            return False
        edges = edges.unionByName(more)
        labels = components(edges)
        return True

    while True:
        rest = materialize(_residual(groups, classes, labels), "open-groups")
        if rest.isEmpty():
            return labels
        if counts_whole and check(_with_ids(_crowded(rest), classes, percent).filter(_enough(percent))):
            rest = materialize(_relabelled(rest, labels), "open-groups")
        large = rest.filter(F.col("members") > GROUP)
        # members of small components lead: once they are compared with all others, a group
        # around one large component is finished
        sizes = large.groupBy("sig", "comp").agg(F.count("*").alias("size"))
        rank = F.row_number().over(W.partitionBy("sig").orderBy("size", "comp", "key"))
        heads = large.join(sizes, ["sig", "comp"]).withColumn("r", rank).filter(F.col("r") <= LEADERS)
        heads = materialize(heads.select(*rest.columns), "heads")
        # a pair meets in no more signatures than either of its sets has left
        own = rest.groupBy("key").agg(F.sum("times").alias("own"))
        x = side(rest.filter(F.col("members") <= GROUP).unionByName(heads).join(own, "key"), "a", "members", "times")
        y = side(rest.join(own, "key"), "b")
        other = F.expr(f"wa + wb <= 0 and ca != cb and ka != kb and (members > {GROUP} or ka < kb)")
        if counts_whole:
            other = other & _enough(percent, F.least("owna", "ownb"))
        meet = (x.join(y, "sig").filter(other & _may_link(percent))
                 .select(F.least("ka", "kb").alias("ka"), F.greatest("ka", "kb").alias("kb"), "members", "times")
                 .groupBy("ka", "kb").agg(F.sum("times").alias("c"), F.max("members").alias("members")))
        pairs = _with_ids(meet, classes, percent)
        if counts_whole:
            # a linked pair shares so many of its emitted parts.  Pairs of a large group
            # pass as they are, for not all their groups are counted yet
            pairs = pairs.filter(_enough(percent) | (F.col("members") > GROUP))
        check(pairs)
        counts_whole = False
        # a group searched in full is finished; a large one loses this round's leaders
        if heads.isEmpty():
            return labels
        groups = large.select("sig", "slack", "key").join(heads.select("sig", "key"), ["sig", "key"], "left_anti")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   percent: int = PERCENT) -> DataFrame:
    """<id>, n_shingles, component_id per input row."""
    if percent < 75:
        raise ValueError("the bands and subsets are laid out for 75 per cent or more")
    few_rows_at_once(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    levels = frequency_levels(rows)
    keys = materialize(set_keys(rows, levels, percent), "set-keys")
    classes = _classes(keys)
    labels = similar_classes(rows, classes, levels, percent)
    # the component of a class, over representatives; other documents take their class's
    named = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left") \
                   .select("n", "key", "key2", F.coalesce("comp", "rep").alias("comp"))
    out = keys.join(named, ["n", "key", "key2"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("comp", "id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents whose id is their component's least, with all their columns."""
    links = link_documents(docs, percent=percent)
    leave = materialize(links.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
                             .select("doc_id").distinct(), "near-copies")
    return docs.join(leave, docs["doc_id"] == leave["doc_id"], "left_anti")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and the least document reachable by links."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return link_documents(docs)


