"""Cross-tokenizer alignment with white-space anchors and memoised windows.

Every text is encoded whole by both tokenizers: blank + text by a byte-level BPE (A) and
the text by a sentencepiece model (B, which adds the blank itself).  A shared end is a byte
offset where a token of A and one of B end.  Shared ends before tokens that both start
with a blank are anchors; they cut a document into windows of token ids.  A window's
alignment depends on its ids only, so it is found once per pair of id tuples and looked up
from then on.  The shared ends cut the tokens into groups; a link joins the two tokens that
end together there.

1. Tasks encode and align their documents and write one packed row per ``BLOCK_BYTES`` of
   text to the shared folder: counts and digest per document, its windows, and the links
   of each distinct window.
2. The links of the corpus are counted per pair of ids: every block sends each of its pairs
   once, with a count, so a pair in a third of all documents costs one row a block.
3. Blocks meet the counts of their own pairs and add them up per document.

Nothing is broadcast but the tokenizer files (fixed size, given by path), nothing is read
by the driver.  The memo is emptied beyond ``MEMO_WINDOWS`` windows, at a block's start.

Texts that are null or empty, or of which the joined bytes of the tokens of A or B are not
blank + text (U+2581 in a text, say), have no tokens: zeros and ''.  Texts are read whole;
special tokens written in a text are plain text; null ids and repeated rows are kept, one
result row per input row; other columns are not read, so names cannot clash; an empty
table gives an empty result.  A's ids come from ``tiktoken`` with the merge ranks of the
file, which was compared with ``tokenizers`` on every code point; texts with a run of
``LONG_BLANK`` white-space characters, which its pattern engine refuses, from
``tokenizers``.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bpe import byte_symbols
from .packing import PACKED, PACKED_SQL, pack, record, rows_of, spans, unpack

BLOCK_BYTES = 4 << 20
#: Texts are encoded so many bytes at a time (or one text).
CHUNK_BYTES = 1 << 20
MEMO_WINDOWS = 150_000
LONG_BLANK = 1000
_BLANK = "▁"


class ByteCoder:
    """Byte-level BPE from a tokenizers file: ids of a text, bytes of an id."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        own = {t: i for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            if own.get(a + b) != len(byte_of) + rank:
                raise ValueError(f"{path}: merges and ids are not in one order")
        ranks = {bytes(byte_of[c] for c in t): i for t, i in own.items() if i < len(byte_of) + len(model["merges"])}
        self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self._slow = Tokenizer.from_file(path)
        self._slow.no_truncation()
        self._slow.no_padding()
        self._slow.encode_special_tokens = True
        self._long = re.compile(r"\s{%d}" % LONG_BLANK)
        tokens = [b""] * (max(model["vocab"].values()) + 1)
        for t, i in model["vocab"].items():
            tokens[i] = bytes(byte_of[c] for c in t) if t in own else t.encode()
        self.tokens = pa.array(tokens, pa.binary())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._slow.encode(t, add_special_tokens=False).ids if self._long.search(t)
                else self._fast.encode_ordinary(t) for t in (" " + t for t in texts)]


class PieceCoder:
    """A sentencepiece model: ids of a text (it adds the blank), bytes of an id."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(self._model.vocab_size()):
            piece = self._model.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece) if self._model.is_byte(i) else None
            tokens.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_BLANK, " ").encode())
        self.tokens = pa.array(tokens, pa.binary())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Aligner:
    """Both tokenizers and the memo of window alignments."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteCoder(path_a), PieceCoder(path_b)
        self.len_a, self.len_b = (pc.binary_length(t).to_numpy().astype(np.int64)
                                  for t in (self.a.tokens, self.b.tokens))
        self.blank_a, self.blank_b = (np.array([t.startswith(b" ") for t in x.tokens.to_pylist()])
                                      for x in (self.a, self.b))
        # how a token is written in a group: before another one, and as the last of its side
        self.n_a, self.n_b = len(self.len_a), len(self.len_b)
        self.written = pa.array([f"{i}{after}" for n, mark in ((self.n_a, "|"), (self.n_b, ";"))
                                 for after in (",", mark) for i in range(n)], pa.string())
        self.forget()

    def forget(self) -> None:
        self.memo: dict[tuple[bytes, bytes], int] = {}
        #: of each window: its groups as text, how many links it has, and its linked ids (A's
        #: above 32 bits of B's), in runs of windows that were aligned together
        self.groups: list[bytes] = []
        self.n_links: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def align(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Align new windows from their ids alone and remember the results."""
        ids_a, ids_b = (np.frombuffer(b"".join(part), np.int32) for part in zip(*keys))
        n_a = np.array([len(k[0]) >> 2 for k in keys])
        end_a, end_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        at_b = np.searchsorted(end_b, end_a)
        at_a = np.flatnonzero(end_b[at_b] == end_a)
        at_b = at_b[at_a]
        # the groups, written one after the other: the tokens of A, then those of B
        size_a, size_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[at_a] = last_b[at_b] = True
        start = np.cumsum(size_a + size_b) - size_a - size_b
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[spans(start, size_a)] = ids_a + np.where(last_a, self.n_a, 0)
        order[spans(start + size_a, size_b)] = ids_b + np.where(last_b, self.n_b, 0) + 2 * self.n_a
        text = self.written.take(pa.array(order))
        stop = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1)[np.append(start, len(order))]
        n_links = np.diff(np.searchsorted(at_a, np.append(0, np.cumsum(n_a))))
        edge = stop[np.append(0, np.cumsum(n_links))].tolist()
        data = text.buffers()[2].to_pybytes()
        self.groups += [data[lo:hi] for lo, hi in zip(edge[:-1], edge[1:])]
        self.n_links.append(n_links)
        self.links.append(ids_a[at_a].astype(np.int64) << 32 | ids_b[at_b])

    def documents(self, texts: list[str]):
        """Per text (tokens of A, tokens of B, its windows)."""
        wanted = [(" " + t).encode() for t in texts]
        size = np.array([len(w) for w in wanted])
        ids_a, n_a, same_a = self._encoded(self.a, texts, wanted, self.len_a, size)
        ids_b, n_b, same_b = self._encoded(self.b, texts, wanted, self.len_b, size)
        good = same_a & same_b & (size > 1)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        # anchors: ends before tokens that start with a blank (or of the text), verified to be shared
        cut_a, end_a = self._before_blanks(ids_a, n_a, self.len_a, self.blank_a)
        cut_b, end_b = self._before_blanks(ids_b, n_b, self.len_b, self.blank_b)
        at_b = np.searchsorted(end_b, end_a)
        shared = end_b[np.minimum(at_b, max(len(end_b) - 1, 0))] == end_a if len(end_b) else np.zeros(0, bool)
        cut_a, cut_b = cut_a[shared], cut_b[at_b[shared]]
        buffer_a, buffer_b = ids_a.tobytes(), ids_b.tobytes()
        known, memo, windows, new, a0, b0 = len(self.groups), self.memo, [], [], 0, 0
        for a1, b1 in zip((4 * cut_a).tolist(), (4 * cut_b).tolist()):
            key = (buffer_a[a0:a1], buffer_b[b0:b1])
            window = memo.get(key)
            if window is None:
                window = memo[key] = known + len(new)
                new.append(key)
            windows.append(window)
            a0, b0 = a1, b1
        if new:
            self.align(new)
        return n_a, n_b, np.diff(np.searchsorted(cut_a, np.append(0, np.cumsum(n_a)), side="right")), windows

    @staticmethod
    def _before_blanks(ids: np.ndarray, n: np.ndarray, lens: np.ndarray, blank: np.ndarray):
        """(number of the next token, byte offset) of every end before a blank or the text's end."""
        stop = np.append(blank[ids], True)[1:] if len(ids) else np.zeros(0, bool)
        stop[np.cumsum(n)[n > 0] - 1] = True
        at = np.flatnonzero(stop)
        return at + 1, np.cumsum(lens[ids])[at]

    @staticmethod
    def _encoded(coder, texts: list[str], wanted: list[bytes], lens: np.ndarray, size: np.ndarray):
        """(ids, tokens of each text, whether its joined bytes are the wanted ones)."""
        lists = coder.encode(texts)
        n = np.array([len(x) for x in lists], np.int64)
        ids = np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum()))
        joined = coder.tokens.take(pa.array(ids)).buffers()[2]
        joined = b"" if joined is None else joined.to_pybytes()
        edge = np.append(0, np.cumsum(lens[ids]))[np.append(0, np.cumsum(n))]
        if np.array_equal(np.diff(edge), size) and joined == b"".join(wanted):
            return ids, n, np.ones(len(texts), bool)
        edge = edge.tolist()
        return ids, n, np.array([joined[lo:hi] == w for lo, hi, w in zip(edge[:-1], edge[1:], wanted)], bool)


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_KINDS = [np.int64, np.bool_, np.int64, np.int64, np.int64, np.uint8, np.int32, np.int64, np.int64, np.int32]
_BLOCK = [("block", pa.int64()), *PACKED, ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())),
          ("n", pa.list_(pa.int64()))]
_BLOCK_SQL = f"block long, {PACKED_SQL}, a array<int>, b array<int>, n array<long>"


class Block:
    """The aligned documents of one row: what each needs once the counts are known."""

    def __init__(self, aligner: Aligner):
        if len(aligner.groups) > MEMO_WINDOWS:
            aligner.forget()
        self.aligner, self.bytes = aligner, 0
        self.docs: list[tuple] = []

    def add(self, ids: list, texts: list[str]) -> None:
        n_a, n_b, n_windows, windows = self.aligner.documents(texts)
        groups, lo, digests = self.aligner.groups, 0, []
        for n in n_windows.tolist():
            text = b"".join([groups[w] for w in windows[lo:lo + n]])
            digests.append(hashlib.sha256(text[:-1]).digest())
            lo += n
        self.docs.append((np.array([i or 0 for i in ids], np.int64), np.array([i is not None for i in ids]),
                          n_a, n_b, n_windows, np.frombuffer(b"".join(digests), np.uint8), np.array(windows, np.int32)))

    def row(self, block: int) -> dict:
        """Distinct windows and distinct pairs get numbers of this block's own."""
        ids, known, n_a, n_b, n_windows, digests, windows = map(np.concatenate, zip(*self.docs))
        used, own, times = np.unique(windows, return_inverse=True, return_counts=True)
        every = np.concatenate([np.zeros(0, np.int64), *self.aligner.n_links])
        n_links = every[used]
        flat = np.concatenate([np.zeros(0, np.int64), *self.aligner.links])[spans((np.cumsum(every) - every)[used], n_links)]
        pairs, pair_of = np.unique(flat, return_inverse=True)
        count = np.bincount(pair_of, np.repeat(times, n_links), len(pairs)).astype(np.int64)
        return {"block": block, **pack(
            [ids, known, n_a, n_b, n_windows, digests, own.astype(np.int32), n_links, pairs, pair_of.astype(np.int32)],
            pa.array([], pa.string())),
            "a": (pairs >> 32).tolist(), "b": (pairs & 0xFFFFFFFF).tolist(), "n": count.tolist()}


def _aligned(batches, path_a: str, path_b: str, block_bytes: int):
    from pyspark import TaskContext

    aligner = _aligner(path_a, path_b)
    part, n, block = TaskContext.get().partitionId(), 0, Block(aligner)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < len(ids):
            before = int(size[lo - 1]) if lo else 0
            hi = min(int(np.searchsorted(size, before + CHUNK_BYTES)) + 1, len(ids))
            block.add(ids[lo:hi], [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])
            block.bytes += int(size[hi - 1]) - before
            lo = hi
            if block.bytes >= block_bytes:
                yield record([block.row((part << 32) + n)], _BLOCK)
                n, block = n + 1, Block(aligner)
    if block.docs:
        yield record([block.row((part << 32) + n)], _BLOCK)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None,
          path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The aligned blocks (block, packed, size, counts, a, b, n), written once: ``a``, ``b``
    and ``n`` are the block's linked id pairs and how many links hold each."""
    import public_tokenizers
    path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
    path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return materialize(rows.mapInArrow(lambda b: _aligned(b, path_a, path_b, block_bytes), _BLOCK_SQL),
                       "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, n_pair, is_best): links of every id pair in the corpus, and whether no other
    id of A is linked more often with this ``b``."""
    total = _pairs(blocks).groupBy("a", "b").agg(F.sum("n").alias("n_pair"))
    return total.withColumn("is_best", F.col("n_pair") == F.max("n_pair").over(Window.partitionBy("b")))


def _pairs(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select(
        "block", F.col("p.a").alias("a"), F.col("p.b").alias("b"), F.col("p.n").alias("n"))


def _scored(block: pa.Table, told: pa.Table) -> pa.Table:
    """Per document of one block: its counts, with the corpus counts of its links."""
    r = block.to_pylist()[0]
    ids, known, n_a, n_b, n_windows, digests, windows, n_links, pairs, pair_of, _ = unpack(
        r["packed"], r["size"], r["counts"], _KINDS)
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    a, b, n, is_best = (told.column(c).to_numpy() for c in ("a", "b", "n_pair", "is_best"))
    at = np.searchsorted(pairs, (a.astype(np.int64) << 32) | b.astype(np.int64))
    count[at], best[at] = n, is_best
    edge = np.append(0, np.cumsum(n_links))
    per = [np.diff(np.append(0, np.cumsum(v))[edge])[windows] for v in (np.ones(len(pair_of), np.int64),
                                                                       best[pair_of], count[pair_of])]
    doc = np.append(0, np.cumsum(n_windows))
    links, n_best, count_sum = (np.diff(np.append(0, np.cumsum(v))[doc]) for v in per)
    hexes = digests.tobytes().hex()
    sha = [hexes[64 * i:64 * i + 64] if n_a[i] else "" for i in range(len(ids))]
    return pa.table({"id": pa.array(ids, mask=~known), "n_a": n_a, "n_b": n_b, "n_groups": links, "n_links": links,
                     "n_best": n_best, "count_sum": count_sum, "groups_sha256": sha})


def document_scores(blocks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: tokens of both, groups, links, how many of its links are the best of
    their B id, the sum of their corpus counts, and the digest of its groups.  Every group
    ends at one shared end, where one token of each tokenizer ends: its one link."""
    told = _pairs(blocks).select(F.col("block").alias("of_block"), "a", "b").join(pair_counts(blocks), ["a", "b"])
    return blocks.select("block", "packed", "size", "counts").groupBy("block").cogroup(
        told.groupBy("of_block")).applyInArrow(
            _scored, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                     "groups_sha256 string").withColumnRenamed("id", id_col)


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Byte-level BPE and sentencepiece tokens of every whole document, aligned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return document_scores(align(docs))
