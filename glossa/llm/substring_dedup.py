"""Substring dedup by super-k-mers: words that repeat an earlier document's window go.

A window is ``width`` consecutive words (maximal runs of bytes other than blank, \\t, \\n,
\\v, \\f, \\r) of one document.  A word is removed when a window that covers it also starts
in a document with a smaller id.

1. *Blocks.*  The texts are packed, ``BLOCK_BYTES`` at a time, one compressed row a block,
   and written to the shared folder, so every later pass sees the same blocks.
2. *Super-k-mers.*  A window's minimiser is the least hash of its ``MINIMISER``-word runs.
   Consecutive windows with one minimiser form a super-k-mer.  Equal super-k-mers of a
   block count once, with the least document id, so a passage that a third of all
   documents share costs one string a block.
3. *Sieve.*  Equal windows have equal minimisers.  Blocks ask, by 48 bits of their distinct
   minimisers, which occur in other blocks too; super-k-mers around the others cannot
   repeat and stay where they are.
4. *Buckets.*  The rest travel, each as one packed string of word codes, to the bucket of
   the minimiser.  A bucket sorts its windows by hash, compares equal hashes word by word
   and takes the least id of each distinct window.  It answers every block with the
   windows that a smaller document of another string holds.
5. *Removal.*  Blocks meet their answers (at most the block's own windows) and drop words.

The sieve also counts exactly how many words each minimiser would send.  Around one with
more than ``HOT`` times a bucket's share (many variants, as in a large group of near copies)
single windows travel instead, dealt by the whole window's hash, which spreads them and
lets equal windows of a block travel once.  Results do not depend on it.  Parts and buckets
follow the text volume (one number, all that the driver reads); on very large inputs larger
``block_bytes`` and ``bucket_bytes`` keep the packed rows from becoming small.

Defined results: null or empty texts have no words; texts shorter than a window lose
nothing; texts are read whole; rows with equal ids do not remove each other's words; a
null id counts as larger than any other, so such rows lose repeats of documents with ids
and never each other's; one result row per input row; columns other than id and text are
not read, so their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .packing import PACKED, PACKED_SQL, pack, record, rows_of, spans, unpack

WIDTH = 13
#: Words of the runs whose least hash is a window's minimiser.
MINIMISER = 5
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: A minimiser that sends more than so many buckets' share sends single windows.
HOT = 4
_NO_ID = np.iinfo(np.int64).max
_rng = np.random.default_rng(20240817)
_PLACES = _rng.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


# -- blocks ----------------------------------------------------------------------------

def _blocks(batches, block_bytes: int):
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    ids: list[pa.Array] = []
    texts: list[pa.Array] = []
    held = 0
    fields = [("block", pa.int64()), ("bytes", pa.int64()), *PACKED]

    def block():
        nonlocal n
        own = pa.concat_arrays(ids)
        values = pc.fill_null(own, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        known = pc.is_valid(own).to_numpy(zero_copy_only=False)
        row = {"block": (part << 32) + n, "bytes": held,
               **pack([values, known], pa.concat_arrays(texts))}
        n += 1
        return record([row], fields)

    for batch in batches:
        id_col, text = batch.column(0), pc.fill_null(batch.column(1), "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < len(text):
            before = int(ends[lo - 1]) if lo else 0
            hi = min(int(np.searchsorted(ends, before + block_bytes - held)) + 1, len(text))
            ids.append(id_col.slice(lo, hi - lo))
            texts.append(text.slice(lo, hi - lo))
            held += int(ends[hi - 1]) - before
            lo = hi
            if held >= block_bytes:
                yield block()
                ids, texts, held = [], [], 0
    if ids:
        yield block()


def pack_blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Rows (block, bytes, packed ids and texts), written once to the shared folder."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    packed = rows.mapInArrow(lambda b: _blocks(b, block_bytes), f"block long, bytes long, {PACKED_SQL}")
    return materialize(packed, "substring-blocks")


# -- super-k-mers ------------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word codes in order, words of each text, the distinct words)."""
    lists = pc.ascii_split_whitespace(texts)
    words, offsets = lists.flatten(), np.asarray(lists.offsets)
    real = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(real.to_numpy(zero_copy_only=False)))
    coded = words.filter(real).dictionary_encode()
    counts = np.diff(before[offsets - offsets[0]])
    return coded.indices.to_numpy(zero_copy_only=False), counts, coded.dictionary


def _runs(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbouring values."""
    n = max(len(values) - width + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += values[j:j + n] * _PLACES[j]
    return _mix(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def group_equal(codes: np.ndarray, h: np.ndarray, start: np.ndarray, length: np.ndarray, lead: np.ndarray):
    """Order the word strings by (lead, content); which of the distinct strings each is, in
    that order, and where each distinct string first stands.  Neighbours with equal hashes
    are compared word by word."""
    power, back = np.full(len(h) + 1, _BASE), np.full(len(h) + 1, _UNBASE)
    power[0] = back[0] = 1
    sums = np.append(np.uint64(0), np.cumsum(h * np.cumprod(power)[:-1], dtype=np.uint64))
    content = (sums[start + length] - sums[start]) * np.cumprod(back)[start]
    order = np.lexsort((length, content, lead))
    s, size, c, b = start[order], length[order], content[order], lead[order]
    same = np.zeros(len(order), bool)
    same[1:] = (c[1:] == c[:-1]) & (size[1:] == size[:-1]) & (b[1:] == b[:-1])
    pairs = np.flatnonzero(same)
    if len(pairs):
        differs = codes[spans(s[pairs], size[pairs])] != codes[spans(s[pairs - 1], size[pairs])]
        same[pairs[np.logical_or.reduceat(differs, np.cumsum(size[pairs]) - size[pairs])]] = False
    return order, np.cumsum(~same) - 1, np.flatnonzero(~same)


def _starts(lens: np.ndarray) -> np.ndarray:
    return np.cumsum(lens) - lens


class Cut:
    """The super-k-mers of one block: every occurrence, and the groups of equal ones, by key
    (48 bits of the minimiser's hash)."""

    def __init__(self, packed, size, counts, width: int):
        self.width = width
        self.ids, self.known, texts = unpack(packed, size, counts, [np.int64, np.bool_])
        rank = np.where(self.known, self.ids, _NO_ID)
        self.codes, self.counts, self.words = split_words(texts)
        n = len(self.codes)
        word_hash = pd.util.hash_array(self.words.to_numpy(zero_copy_only=False), categorize=False) \
            if len(self.words) else np.zeros(0, np.uint64)
        self.h = word_hash[self.codes]
        m = min(MINIMISER, width)
        least = _least(_runs(self.h, m), width - m + 1)
        left = np.repeat(np.cumsum(self.counts), self.counts) - np.arange(n)
        windows = np.flatnonzero(left[:len(least)] >= width)
        key = (_mix(least[windows]) >> np.uint64(16)).astype(np.int64)
        head = np.ones(len(windows), bool)
        head[1:] = (np.diff(windows) != 1) | (key[1:] != key[:-1])
        first = np.flatnonzero(head)
        start, n_windows, key = windows[first], np.diff(np.append(first, len(windows))), key[first]
        doc = rank[np.repeat(np.arange(len(self.counts)), self.counts)[start]] if n else start
        order, self.group, head = group_equal(self.codes, self.h, start, n_windows + width - 1, key)
        #: of every occurrence, ordered by key and content
        self.start, self.n_windows, self.doc = start[order], n_windows[order], doc[order]
        #: of every group
        self.g_start, self.g_windows, self.g_key = self.start[head], self.n_windows[head], key[order][head]
        self.g_doc = np.minimum.reduceat(self.doc, head) if len(head) else self.doc
        #: of every distinct key
        self.keys, first, self.k_groups = np.unique(self.g_key, return_index=True, return_counts=True)
        self.k_words = np.add.reduceat(self.g_windows + width - 1, first) if len(first) else first

    def requests(self, n_parts: int):
        """The block's distinct keys and the words they would send, by part."""
        part = self.keys % n_parts
        for p in np.unique(part):
            own = part == p
            yield {"no": int(p), **pack([np.diff(self.keys[own], prepend=0), self.k_words[own].astype(np.int32)], _NO_TEXT)}

    def units(self, replies: list[tuple], n_buckets: int) -> "Units":
        """What travels, given the states of the block's keys (no, packed, size, counts)."""
        state, n_parts = np.zeros(len(self.keys), np.int8), max((r[4] for r in replies), default=1)
        part = self.keys % n_parts
        for no, packed, size, counts, _ in replies:
            state[part == no] = unpack(packed, size, counts, [np.int8])[0]
        # two strings of this block around one minimiser may share windows as well
        state = np.maximum(state, (self.k_groups > 1).astype(np.int8))
        return Units(self, np.repeat(state, self.k_groups), n_buckets)


class Units:
    """The strings that a block sends, by bucket: whole super-k-mers, or the distinct single
    windows of those around a hot minimiser."""

    def __init__(self, cut: Cut, state: np.ndarray, n_buckets: int):
        self.cut = cut
        whole, hot = np.flatnonzero(state == 1), np.flatnonzero(state == 2)
        width = cut.width
        single = spans(cut.g_start[hot], cut.g_windows[hot])
        fine = (_runs(cut.h, width)[single] % np.uint64(n_buckets)).astype(np.int64)
        order, of_window, head = group_equal(cut.codes, cut.h, single, np.full(len(single), width), fine)
        doc = np.repeat(cut.g_doc[hot], cut.g_windows[hot])[order]
        start = np.append(cut.g_start[whole], single[order][head])
        windows = np.append(cut.g_windows[whole], np.ones(len(head), np.int64))
        doc = np.append(cut.g_doc[whole], np.minimum.reduceat(doc, head) if len(head) else doc)
        bucket = np.append(cut.g_key[whole] % n_buckets, fine[order][head])
        by = np.argsort(bucket, kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        self.start, self.windows, self.doc, self.bucket = start[by], windows[by], doc[by], bucket[by]
        edge = np.flatnonzero(np.diff(self.bucket, prepend=-1, append=-1)) if len(by) else by
        #: (bucket, first unit, end)
        self.buckets = [(int(self.bucket[lo]), int(lo), int(hi)) for lo, hi in zip(edge[:-1], edge[1:])]
        # which windows of the block's groups each unit's windows stand for
        self.at = _starts(self.windows)
        group_at = _starts(cut.g_windows)
        self.slots = np.append(spans(group_at[whole], cut.g_windows[whole]),
                               spans(group_at[hot], cut.g_windows[hot])[order])
        self.stands = np.append(spans(self.at[place[:len(whole)]], cut.g_windows[whole]),
                                self.at[place[len(whole):]][of_window])

    def strings(self):
        """One packed row per bucket: lengths, least ids and word codes of its strings."""
        cut, length = self.cut, self.windows + self.cut.width - 1
        for bucket, lo, hi in self.buckets:
            codes = cut.codes[spans(self.start[lo:hi], length[lo:hi])]
            used, own = np.unique(codes, return_inverse=True)
            yield {"no": bucket, **pack([length[lo:hi].astype(np.int32), self.doc[lo:hi], own.astype(np.int32)],
                                        cut.words.take(pa.array(used)))}

    def least(self, answers: list[tuple]) -> np.ndarray:
        """The least id of every window of the block's groups, given the buckets' answers."""
        told = np.repeat(self.doc, self.windows)
        first = {bucket: lo for bucket, lo, _ in self.buckets}
        for no, packed, size, counts, _ in answers:
            string, offset, doc, _ = unpack(packed, size, counts, [np.int32, np.int32, np.int64])
            place = self.at[first[no] + string] + offset
            told[place] = np.minimum(told[place], doc)
        out = np.repeat(self.cut.g_doc, self.cut.g_windows)
        out[self.slots] = np.minimum(out[self.slots], told[self.stands])
        return out


# -- sieve -------------------------------------------------------------------------------

_NO_TEXT = pa.array([], pa.string())
#: ``no`` is the part or bucket that a packed row goes to or comes from, ``parts`` how many parts there are.
_ROW = [("block", pa.int64()), ("no", pa.int64()), *PACKED, ("parts", pa.int64())]
_ROW_SQL = f"block long, no long, {PACKED_SQL}, parts long"


def _fields(table: pa.Table, kind: int | None = None) -> list[tuple]:
    if kind is not None:
        table = table.filter(pc.equal(table.column("kind"), kind))
    return list(zip(*(table.column(c).to_pylist() for c in ("no", "packed", "size", "counts", "parts"))))


def _states(table: pa.Table, hot_words: int) -> pa.Table:
    """One part of the keys: 0 for a key of one block, 1 for one of several, 2 for one that
    would send more than ``hot_words`` words to its bucket."""
    blocks, rows = table.column("block").to_pylist(), _fields(table)
    asked = [unpack(packed, size, counts, [np.int64, np.int32]) for _, packed, size, counts, _ in rows]
    _, which, times = np.unique(np.concatenate([np.cumsum(a[0]) for a in asked]), return_inverse=True, return_counts=True)
    words = np.bincount(which, np.concatenate([a[1] for a in asked]))
    state = np.where(words > hot_words, 2, times > 1).astype(np.int8)[which]
    edge = np.cumsum([len(a[0]) for a in asked])
    out = [{"block": b, "no": r[0], "parts": r[4], **pack([own], _NO_TEXT)}
           for b, r, own in zip(blocks, rows, np.split(state, edge[:-1]))]
    return pa.Table.from_batches([record(out, _ROW)])


# -- buckets -----------------------------------------------------------------------------

def _answers(table: pa.Table, width: int) -> pa.Table:
    """One bucket: the least id of every distinct window, told to the blocks that lack it."""
    rows = [unpack(packed, size, counts, [np.int32, np.int64, np.int32])
            for _, packed, size, counts, _ in _fields(table)]
    n_words = np.array([len(r[3]) for r in rows])
    coded = pa.concat_arrays([r[3] for r in rows]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    base = np.cumsum(n_words) - n_words
    codes = coded[np.concatenate([r[2] + b for r, b in zip(rows, base)])]
    length = np.concatenate([r[0] for r in rows]).astype(np.int64)
    doc = np.concatenate([r[1] for r in rows])
    n_windows = length - width + 1
    start = spans(np.cumsum(length) - length, n_windows)
    string = np.repeat(np.arange(len(length)), n_windows)
    key = _runs(_mix(codes.astype(np.uint64) + np.uint64(1)), width)[start]
    order = np.argsort(key, kind="stable")
    new = np.append(True, key[order][1:] != key[order][:-1])
    if not _equal_runs(codes, start[order], new, width):
        # windows whose hashes meet though their words differ: sort by the words themselves
        columns = [codes[start + j] for j in range(width)]
        order = np.lexsort(columns)
        new = np.append(True, np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns]))
    least = np.minimum.reduceat(doc[string[order]], np.flatnonzero(new))
    least = least[np.cumsum(new) - 1]
    told = np.empty(len(order), np.int64)
    told[order] = least
    offset = np.arange(len(start)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    smaller = np.flatnonzero(told < doc[string])
    n_strings = np.array([len(r[0]) for r in rows])
    row_of = np.repeat(np.arange(len(rows)), n_strings)
    first = np.cumsum(n_strings) - n_strings
    out = []
    cut = np.searchsorted(row_of[string[smaller]], np.arange(len(rows) + 1))
    blocks, bucket = table.column("block").to_pylist(), table.column("no")[0].as_py()
    for i in range(len(rows)):
        at = smaller[cut[i]:cut[i + 1]]
        if len(at):
            out.append({"block": blocks[i], "no": bucket, "parts": 0, **pack(
                [(string[at] - first[i]).astype(np.int32), offset[at].astype(np.int32), told[at]], _NO_TEXT)})
    return pa.Table.from_batches([record(out, _ROW)])


def _equal_runs(codes: np.ndarray, start: np.ndarray, new: np.ndarray, width: int) -> bool:
    """Whether all windows of each run of equal hashes have the same words."""
    follow = np.flatnonzero(~new)
    a, b = start[follow], start[follow - 1]
    return all(np.array_equal(codes[a + j], codes[b + j]) for j in range(width))


# -- removal -----------------------------------------------------------------------------

def _cleaned(block: pa.Table, told: pa.Table, width: int, n_buckets: int) -> pa.Table:
    """The documents of one block without the words that earlier documents have."""
    r = block.to_pylist()[0]
    cut = Cut(r["packed"], r["size"], r["counts"], width)
    least = cut.units(_fields(told, _REPLY), n_buckets).least(_fields(told, _ANSWER))
    repeated = least[spans(_starts(cut.g_windows)[cut.group], cut.n_windows)] < np.repeat(cut.doc, cut.n_windows)
    begins = spans(cut.start, cut.n_windows)[repeated]
    n_codes = len(cut.codes) + 1
    cover = np.bincount(begins, minlength=n_codes) - np.bincount(begins + width, minlength=n_codes)
    keep = np.cumsum(cover)[:-1] == 0
    edge = np.append(0, np.cumsum(cut.counts))
    kept = np.append(0, np.cumsum(keep))[edge]
    words = cut.words.take(pa.array(cut.codes[keep]))
    lists = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), words)
    return pa.table({
        "id": pa.array(cut.ids, mask=~cut.known), "n_words": pa.array(cut.counts.astype(np.int64)),
        "n_removed": pa.array(cut.counts - np.diff(kept)), "kept": pc.binary_join(lists, " ")})


_REPLY, _ANSWER = 0, 1


def key_states(blocks: DataFrame, width: int, n_parts: int, hot_words: int) -> DataFrame:
    """The sieve's replies: of every block's keys, which occur in other blocks too."""
    def requests(batches):
        for r in rows_of(batches):
            rows = [{"block": r["block"], "parts": n_parts, **x}
                    for x in Cut(r["packed"], r["size"], r["counts"], width).requests(n_parts)]
            if rows:
                yield record(rows, _ROW)

    asked = blocks.select("block", "packed", "size", "counts").mapInArrow(requests, _ROW_SQL)
    states = asked.groupBy("no").applyInArrow(lambda t: _states(t, hot_words), _ROW_SQL)
    return materialize(states, "substring-key-states")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                   block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(``id_col``, n_words, n_removed, kept): every document's words without those in a
    window that also starts in a document with a smaller id, joined by one blank."""
    blocks = pack_blocks(docs, id_col, text_col, block_bytes)
    volume = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n_buckets = max(1, -(-volume // bucket_bytes))
    # a word takes about eight bytes with the blank after it
    replies = key_states(blocks, width, n_buckets, HOT * bucket_bytes // 8)

    def strings(block: pa.Table, told: pa.Table) -> pa.Table:
        r = block.to_pylist()[0]
        units = Cut(r["packed"], r["size"], r["counts"], width).units(_fields(told), n_buckets)
        rows = [{"block": r["block"], "parts": 0, **x} for x in units.strings()]
        return pa.Table.from_batches([record(rows, _ROW)])

    own = blocks.select("block", "packed", "size", "counts").groupBy("block")
    sent = own.cogroup(replies.withColumnRenamed("block", "of_block").groupBy("of_block")).applyInArrow(strings, _ROW_SQL)
    answers = sent.groupBy("no").applyInArrow(lambda t: _answers(t, width), _ROW_SQL)
    told = replies.withColumn("kind", F.lit(_REPLY)).unionByName(answers.withColumn("kind", F.lit(_ANSWER)))
    cleaned = own.cogroup(told.withColumnRenamed("block", "of_block").groupBy("of_block")).applyInArrow(
        lambda block, rows: _cleaned(block, rows, width, n_buckets), "id long, n_words long, n_removed long, kept string")
    return cleaned.withColumnRenamed("id", id_col)


def op11_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words left in every document without the 13-word windows of earlier documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
