"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

* Features: hashed 1- to 3-grams of the lower-cased text, in which every run of
  non-letters is one blank.  Their weight is term frequency (count over all n-grams of
  the text) times inverse document frequency.
* Document frequencies are counted over *all* training documents, each task adding up
  its own documents before the shuffle.
* The classifier is fitted on a bounded sample of labelled rows (``max_rows``; of each
  label the ``PER_LABEL`` with the smallest hashed ids, then those of all labels) with the
  follow-the-regularised-leader (proximal) update, whose elastic-net penalty keeps the
  weights sparse.  One in five sample rows is set aside to fit the temperature that
  calibrates the scores.
* Prediction streams every whole text through ``mapInArrow``; the model is a
  2**FEATURE_BITS x languages table, whose size does not depend on the data.

Defined results: a text that is null or has no letter is ``und`` with score 0; without
training rows every text is ``und``; ties go to the language that sorts first; rows with
a null id train (their id has no checksum); repeated rows get equal results; extra
columns are ignored, or kept by :func:`accept`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import few_rows_at_once

FEATURE_BITS = 16
ORDERS = (1, 2, 3)
#: Rows the classifier is fitted on, at most.
MAX_ROWS = 4000
#: Rows of every label that come before the others.
PER_LABEL = 50
EPOCHS = 3
#: Term frequencies are shares of a text; this brings a text's vector near unit length.
SCALE = 20.0
#: FTRL-proximal step and elastic-net strengths.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
#: Documents below this calibrated score are rejected by :func:`accept`.
MIN_SCORE = 0.4
#: Characters worked on at a time; small arrays stay in the processor's cache.
CHUNK_CHARS = 250_000
_D = 1 << FEATURE_BITS
#: Feature number of "no n-gram here" (its weight row is 0).
_VOID = _D
#: Odd multipliers of the n-gram hash, one per position.
_ODD = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Per code point: itself if a letter, else the blank."""
    if not _FOLD:
        _FOLD.append(np.fromiter((c if chr(c).isalpha() else 32 for c in range(0x110000)), np.uint32, 0x110000))
    return _FOLD[0]


def _features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashed n-grams of the folded texts: per order an array over all positions (``_VOID``
    where no n-gram starts), the number of positions and of n-grams per text.  A text
    without letters has no position."""
    raw = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.array([len(r) // 4 for r in raw], np.int64)
    codes = _fold_table()[np.frombuffer(b"".join(raw), np.uint32)]
    # runs of non-letters become one blank, none at a text's ends
    owner_end = np.cumsum(size)
    first = np.zeros(codes.size, bool)
    first[(owner_end - size)[size > 0]] = True
    keep = (codes != 32) | np.append(codes[1:] != 32, False) & ~first & ~np.append(first[1:], False)
    position = np.append(0, np.cumsum(keep))
    kept = position[owner_end] - position[owner_end - size]
    codes = codes[keep]
    ends = np.cumsum(kept)
    out, h = [], None
    grams = np.zeros(len(texts), np.int64)
    for o in ORDERS:
        step = codes * _ODD[o - 1]
        h = step if h is None else (h[:-1] ^ step[o - 1:])
        h = h * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        f = np.full(codes.size, _VOID, np.int32)
        f[:h.size] = (h * np.uint32(0x27D4EB2F)) >> np.uint32(32 - FEATURE_BITS)
        for j in range(1, o):  # n-grams that would run over the end of a text
            f[(ends - j)[kept >= j]] = _VOID
        out.append(f)
        grams += np.maximum(kept - o + 1, 0)
    return out, kept, grams


def _per_text(texts: list[str]):
    """The features of each text as one array."""
    for lo, hi in _chunks(texts):
        orders, kept, _ = _features([t or "" for t in texts[lo:hi]])
        ends = np.cumsum(kept)
        for e, k in zip(ends, kept):
            f = np.concatenate([o[e - k:e] for o in orders])
            yield f[f != _VOID]


def _chunks(texts):
    start, chars = 0, 0
    for i, t in enumerate(texts):
        chars += len(t or "")
        if chars >= CHUNK_CHARS:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


# -- corpus statistics -----------------------------------------------------------------------
def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(feature, df) over all documents, and their number as feature -1."""
    def run(batches):
        df, n = np.zeros(_D, np.int64), 0
        for batch in batches:
            for f in _per_text(batch.column(0).to_pylist()):
                if f.size:
                    n += 1
                    seen = np.zeros(_D, bool)
                    seen[f] = True
                    df += seen
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(hit, -1), pa.int32()), pa.array(np.append(df[hit], n), pa.int64())],
            names=["feature", "df"])

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "feature int, df bigint")
    return parts.groupBy("feature").agg(F.sum("df").alias("df"))


# -- training --------------------------------------------------------------------------------
def training_sample(docs: DataFrame, id_col: str, text_col: str, label_col: str,
                    max_rows: int = MAX_ROWS) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(label, features, counts) of at most ``max_rows`` labelled rows: the ``PER_LABEL`` with
    the smallest hashed ids of each label (in turns, if there are many labels), then the others.  Only ids and labels are ranked; texts are read for the chosen
    rows and leave the executors as counted features."""
    # the hash of (id, label) picks rows by chance; the text is not needed for that
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(label_col))
    edge = (docs.filter(F.col(label_col).isNotNull()).select(key.alias("h"))
                .orderBy("h").limit(max_rows).agg(F.max("h")).first()[0])
    if edge is None:
        return []
    # at most PER_LABEL rows a label leave a task
    rank = F.row_number().over(W.partitionBy("label").orderBy("h"))
    first = (docs.filter(F.col(label_col).isNotNull())
                 .select(F.col(label_col).cast("string").alias("label"), key.alias("h"))
                 .withColumn("r", rank).filter(F.col("r") <= PER_LABEL)
                 .orderBy("r", "h").limit(max_rows).groupBy("h").agg(F.min("r").alias("r")))  # max_rows rows
    rows = docs.filter(F.col(label_col).isNotNull()) \
               .select(F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text"),
                       key.alias("h")) \
               .join(F.broadcast(first), "h", "left").filter(F.col("r").isNotNull() | (F.col("h") <= edge)) \
               .select("label", "text", "h", F.coalesce("r", F.lit(PER_LABEL + 1)).alias("r"))

    def run(batches):
        for batch in batches:
            keep, feats, counts = [], [], []
            for i, f in enumerate(_per_text(batch.column(1).to_pylist())):
                if f.size:
                    u, c = np.unique(f, return_counts=True)
                    keep.append(i)
                    feats.append(u)
                    counts.append(c.astype(np.int32))
            if keep:
                at = pa.array(keep)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(feats, pa.list_(pa.int32())),
                     pa.array(counts, pa.list_(pa.int32())), batch.column(2).take(at), batch.column(3).take(at)],
                    names=["label", "f", "n", "h", "r"])

    out = rows.mapInArrow(run, "label string, f array<int>, n array<int>, h bigint, r int")
    # repeated rows share a hash; the bound holds all the same
    table = out.orderBy("r", "h", "label", F.xxhash64("f", "n")).limit(max_rows).toArrow().combine_chunks()
    table = table.take(pa.array(np.argsort(np.asarray(table.column("h")), kind="stable")))
    return [(label, np.asarray(f.values), np.asarray(n.values))
            for label, f, n in zip(table.column("label").to_pylist(), table.column("f").combine_chunks(),
                                   table.column("n").combine_chunks())]


def fit_ftrl(rows, idf: np.ndarray, labels: list[str], epochs: int = EPOCHS,
             alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Sparse weights (features x labels).  Per coordinate: z gathers gradients less the
    proximal term, n the squared gradients; a weight is 0 until |z| passes l1."""
    k = len(labels)
    z, n = np.zeros((_D, k)), np.zeros((_D, k))
    number = {x: i for i, x in enumerate(labels)}

    def weights(f):
        zf = z[f]
        return np.where(np.abs(zf) <= l1, 0.0,
                        -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, f, c = rows[i]
            x = _tfidf(f, c, idf)
            w = weights(f)
            p = _softmax(x @ w)
            p[number[label]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[f] + g * g) - np.sqrt(n[f])) / alpha
            z[f] += g - sigma * w
            n[f] += g * g
    return weights(np.arange(_D))


def _tfidf(f, c, idf):
    return SCALE * c / c.sum() * idf[f]


def _softmax(s):
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(scores: np.ndarray, truth: np.ndarray) -> float:
    """The temperature on a fixed geometric grid with the least log loss."""
    if not len(truth):
        return 1.0
    grid = np.geomspace(0.5, 20, 75)
    loss = [-np.log(np.maximum(_softmax(scores / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        max_rows: int = MAX_ROWS):
    """Model: labels, weights already multiplied by idf and temperature."""
    few_rows_at_once(train.sparkSession)
    df = document_frequencies(train, text_col).toArrow()  # at most 2**FEATURE_BITS + 1 rows
    feature, count = np.asarray(df.column("feature")), np.asarray(df.column("df"))
    total = int(count[feature == -1].sum()) if feature.size else 0
    freq = np.zeros(_D)
    freq[feature[feature >= 0]] = count[feature >= 0]
    idf = np.log((1 + total) / (1 + freq)) + 1
    rows = training_sample(train, id_col, text_col, label_col, max_rows)
    labels = sorted({r[0] for r in rows})
    if not labels:
        return [], np.zeros((_D, 0), np.float32)
    known = {r[0] for i, r in enumerate(rows) if i % 5}  # the only row of a label isn't set aside
    parted = len(rows) >= 50
    aside = [r for i, r in enumerate(rows) if parted and i % 5 == 0 and r[0] in known]
    learn = [r for i, r in enumerate(rows) if not parted or i % 5 or r[0] not in known]
    weights = fit_ftrl(learn, idf, labels)
    number = {x: i for i, x in enumerate(labels)}
    scores = np.array([_tfidf(f, c, idf) @ weights[f] for _, f, c in aside]).reshape(-1, len(labels))
    t = fit_temperature(scores, np.array([number[x] for x, _, _ in aside], int))
    return labels, (SCALE * weights * idf[:, None] / t).astype(np.float32)


# -- prediction ------------------------------------------------------------------------------
def _score(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Mean weight row over all n-grams of each text (nan without any)."""
    orders, kept, grams = _features(texts)
    total = np.zeros((len(texts), weights.shape[1]))
    some = kept > 0
    if some.any():
        w = weights.take(orders[0], axis=0, mode="clip")
        for f in orders[1:]:
            w += weights.take(f, axis=0, mode="clip")
        total[some] = np.add.reduceat(w, (np.cumsum(kept) - kept)[some], axis=0, dtype=np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        return total / grams[:, None]


def predict(docs: DataFrame, model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus lang_pred and score.  A text that is kept goes to Python once."""
    labels, weights = model
    few_rows_at_once(docs.sparkSession)
    # one more row of zeros, for places where no n-gram starts; a fixed size
    shared = docs.sparkSession.sparkContext.broadcast(np.vstack([weights, np.zeros_like(weights[:1])]))

    def run(batches):
        w = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in _chunks(texts):
                s = _score([t or "" for t in texts[lo:hi]], w)
                known = ~np.isnan(s).any(axis=1) & bool(labels)
                p = _softmax(np.where(known[:, None], s, 0.0)) if labels else np.zeros((hi - lo, 1))
                best = p.argmax(axis=1)
                lang = [labels[b] if k else "und" for b, k in zip(best, known)]
                score = np.where(known, p[np.arange(hi - lo), best], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(lo, hi - lo) for i in range(len(keep))),
                     pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["lang_pred string", "score double"])
    own = text_col in keep and kinds[text_col] == "string"
    at = keep.index(text_col) if own else len(keep)
    more = [] if own else [F.col(text_col).cast("string").alias("__text")]
    return docs.select(*keep, *more).mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that never trains."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def accept(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents whose language is recognised, with all their columns: neither
    ``und`` nor scored below ``min_score``."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    names = docs.columns
    judged = predict(docs.withColumnsRenamed({n: f"c{i}" for i, n in enumerate(names)}),
                     model, [f"c{i}" for i in range(len(names))], f"c{names.index('text')}")
    kept = judged.filter((F.col("lang_pred") != "und") & (F.col("score") >= min_score))
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    out = predict(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")
