"""BPE encoding and decoding by batched numpy merge rounds.

The texts are normalised and split like the tokenizer file says (NFC, white space,
lower case, word pattern).  Every *distinct* word of a batch is encoded once: the
symbols of all its words lie in one flat array, neighbouring symbols form pair keys, and
a binary search over the vocabulary's sorted pair keys gives each pair's merge rank.  One
round merges the lowest-ranked pairs of every word at once; words without a known pair
leave the array.  Documents then become token ids by gathering their words' ids.

The vocabulary (a file of fixed size, given by path) is loaded once per Python worker;
rows stream through ``mapInArrow``, so nothing is shuffled and memory is bounded by one
Arrow batch plus the worker's word cache (emptied beyond ``CACHE_WORDS`` words).

Defined results: a null text counts as empty and has no tokens; texts of any length are
encoded whole; special tokens written in a text become their ids; unknown columns are
dropped by :func:`encode` except those named in ``keep``; empty tables give empty results.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import few_rows_at_once

#: Distinct words a worker remembers before it starts anew.
CACHE_WORDS = 200_000
#: Words per merge batch.
BATCH_WORDS = 100_000
_NONE = np.iinfo(np.int64).max


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others for U+0100 and up."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(rest)) for b in range(256)]


def _older_letters(pattern: str) -> str:
    """The pattern with letters and digits as Python's own Unicode tables have them: the
    ``regex`` module knows scripts that were added since, tokenizers doesn't."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    newer = [ord(c) for c in regex.findall(r"[\p{L}\p{N}]", every)
             if unicodedata.category(c)[0] not in "LN"]
    if not newer:
        return pattern
    spans, start = [], newer[0]
    for a, b in zip(newer, [*newer[1:], -1]):
        if b != a + 1:
            spans.append(f"\\U{start:08x}-\\U{a:08x}")
            start = b
    out = "[" + "".join(spans) + "]"
    return (pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|{out})")
                   .replace(r"[\p{L}]", rf"[\p{{L}}--{out}]").replace(r"[\p{N}]", rf"[\p{{N}}--{out}]"))


def _latin_pattern(pattern: str) -> str:
    """The pattern for Latin-1 texts, with its classes spelled out; Python's ``re`` runs
    it several times faster than the Unicode form."""
    import regex

    latin = "".join(map(chr, range(256)))
    letters, numbers, space = ("".join(map(re.escape, regex.findall(c, latin)))
                               for c in (r"\p{L}", r"\p{N}", r"\s"))
    return (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
                   .replace(r"[\p{L}]", f"[{letters}]").replace(r"[\p{N}]", f"[{numbers}]"))


class Bpe:
    """Vocabulary and merge table of one tokenizer file, with a cache of encoded words."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in (vocab | self.special).items():
            self.tokens[i] = token
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(_older_letters(split), flags=regex.V1)
        self.latin = re.compile(_latin_pattern(split))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        self.width = np.int64(len(self.tokens))
        left = np.array([vocab[a] for a, _ in model["merges"]], np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], np.int64)
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.forget()

    def forget(self) -> None:
        """Empty the word cache; special tokens are its first words."""
        self.known = {t: n for n, t in enumerate(self.special)}
        self.ids = [np.array(list(self.special.values()), np.int64)]
        self.sizes = [np.ones(len(self.special), np.int64)]

    # -- merge rounds -------------------------------------------------------------------
    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in order, ids per word) for non-empty words."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(r) for r in raw], np.int64)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(size) - 1
        sym = self.first[flat]
        sym[ends] = self.last[flat[ends]]
        word = np.repeat(np.arange(len(raw)), size)
        done_sym, done_word = [], []
        while sym.size:
            key = sym[:-1] * self.width + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), self.keys.size - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.rank[at], _NONE), _NONE)
            new = np.append(True, word[1:] != word[:-1])
            run = np.cumsum(new) - 1
            best = np.minimum.reduceat(rank, np.flatnonzero(new))[run]
            over = best == _NONE  # these words have no pair left
            pick = np.flatnonzero((rank == best) & ~over)
            if pick.size:
                # of overlapping pairs (a a a) every second one merges, from the left
                fresh = np.append(True, np.diff(pick) != 1)
                nth = np.arange(pick.size) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
                pick = pick[nth % 2 == 0]
                sym[pick] = self.made[at[pick]]
            stay = ~over
            stay[pick + 1] = False
            done_sym.append(sym[over])
            done_word.append(word[over])
            sym, word = sym[stay], word[stay]
        ids, owner = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(raw))

    # -- texts --------------------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """Words of a text; special tokens stand as words of their own."""
        if self.specials and "<|" in text and self.specials.search(text):
            out = []
            for part in self.specials.split(text):
                out += [part] if part in self.special else self._words(part)
            return out
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        text = _normal(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words.findall(text)
        return self.latin.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids per text)."""
        known, numbers, per_text, fresh = self.known, [], [], []
        for text in texts:
            words = self.split(text)
            per_text.append(len(words))
            for w in words:
                n = known.get(w)
                if n is None:
                    n = known[w] = len(known)
                    fresh.append(w)
                numbers.append(n)
        for i in range(0, len(fresh), BATCH_WORDS):
            ids, size = self.merge_words(fresh[i:i + BATCH_WORDS])
            self.ids.append(ids)
            self.sizes.append(size)
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        ids, size = self.ids[0], self.sizes[0]
        start = np.cumsum(size) - size
        number = np.array(numbers, np.int64)
        length = size[number]
        total = np.cumsum(length)
        where = np.repeat(start[number] - (total - length), length) + np.arange(total[-1] if total.size else 0)
        bounds = np.append(0, total)[np.append(0, np.cumsum(np.array(per_text, np.int64)))]
        if len(known) > CACHE_WORDS:
            self.forget()
        return ids[where], np.diff(bounds)

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts joined by one space, as a tokenizer without decoder does."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def _normal(text: str) -> str:
    # lower case letter by letter: no special form of sigma at a word's end
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


_LOADED: dict[str, Bpe] = {}


def _load(path: str) -> Bpe:
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


#: Characters encoded at a time inside a task.
CHUNK_CHARS = 1_000_000


def _slices(column: pa.Array):
    """Row ranges of about CHUNK_CHARS characters, so only a part of an Arrow batch ever
    exists as Python strings."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(column):
        hi = int(np.searchsorted(size, (size[lo - 1] if lo else 0) + CHUNK_CHARS)) + 1
        yield lo, min(hi, len(column))
        lo = hi


def _encoded(batches, path: str, held: int):
    """Batches whose last column is the text -> the ``held`` first columns and the ids."""
    bpe = _load(path)
    for batch in batches:
        for lo, hi in _slices(batch.column(held)):
            part = batch.slice(lo, hi - lo)
            ids, sizes = bpe.encode([t or "" for t in part.column(held).to_pylist()])
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns[:held], lists],
                                             names=[*part.schema.names[:held], "ids"])


def _decoded(batches, path: str, held: int):
    """Batches whose column ``held`` is the ids -> the same batches and the text."""
    bpe = _load(path)
    for batch in batches:
        lists = batch.column(held)
        texts = pa.array([bpe.decode(x.values.to_pylist()) if x.is_valid else "" for x in lists], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:held + 1], texts],
                                         names=[*batch.schema.names[:held + 1], "decoded"])


def _schema(df: DataFrame, keep: list[str], *extra: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), *extra])


def _texts(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    few_rows_at_once(docs.sparkSession)
    return docs.select(*keep, F.col(text_col).cast("string").alias("__text"))


def encode(docs: DataFrame, keep: list[str], text_col: str = "text",
           vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns plus ``ids`` (array<int>): the token ids of the whole text."""
    path, held = vocabulary or default_vocabulary(), len(keep)
    return _texts(docs, keep, text_col).mapInArrow(
        lambda batches: _encoded(batches, path, held), _schema(docs, keep, "ids array<int>"))


def decode(encoded: DataFrame, keep: list[str], vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns, ``ids`` and ``decoded``: the text of the ids."""
    path, held = vocabulary or default_vocabulary(), len(keep)
    return encoded.select(*keep, "ids").mapInArrow(
        lambda batches: _decoded(batches, path, held),
        _schema(encoded, keep, "ids array<int>", "decoded string"))


def encode_decode(docs: DataFrame, keep: list[str], text_col: str = "text",
                  vocabulary: str | None = None) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: one Python worker per task."""
    path, held = vocabulary or default_vocabulary(), len(keep)
    return _texts(docs, keep, text_col).mapInArrow(
        lambda batches: _decoded(_encoded(batches, path, held), path, held),
        _schema(docs, keep, "ids array<int>", "decoded string"))


def token_digests(docs: DataFrame, keep: list[str], text_col: str = "text",
                  vocabulary: str | None = None) -> DataFrame:
    """``keep``, n_tokens, ids_sha256 and decoded_sha256 of the whole texts."""
    both = encode_decode(docs, keep, text_col, vocabulary)
    return both.select(*keep, F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """Token counts and digests of every whole document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_digests(docs, ["doc_id"])
