"""Mixing to target weights with soft domain membership.

1. A multinomial naive Bayes table over hashed words is counted from all labelled rows
   (bucket x domain, its size fixed by ``BUCKETS`` and the number of domains).
2. Every document gets domain posteriors.  The evidence of a text is its mean word
   log-likelihood times at most ``EVIDENCE`` words, so long texts stay soft.
3. Document rates r >= 0 are fitted by distributed projected-gradient least squares: the
   expected tokens per domain, sum of r * tokens * posterior, shall equal the targets.  A
   small ridge keeps rates near 1.  Every step is one aggregate of D sums over the table
   of posteriors; a document's rate follows from the D-value steps so far, so no state is
   rewritten and only D numbers reach the driver.
4. A rate of 2.3 gives two copies, and a third for the 30 % of the documents whose
   seeded hash falls below the fraction.

A domain is a value of ``domain_col`` (the query: language).  Without explicit weights,
the targets are the present token shares to the power ``SMOOTHING``, of the same total.

Defined results: a null or blank text has no tokens, the prior as posterior and rate 1; a
row without label is classified and mixed like the others; without any label all rates are
1; repeated rows get the same rate; an empty table gives an empty result.  Extra columns
are kept by :func:`mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BUCKETS = 1 << 14
EVIDENCE = 50
SMOOTHING = 0.7
RIDGE = 1e-4
STEPS, TOLERANCE = 40, 1e-4
#: Domains at most; more would make the table of word counts unbounded.
MAX_DOMAINS = 256
_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SPACE), "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _total(cols: list[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def word_table(docs: DataFrame, text_col: str, domain_col: str, domains: list[str]) -> DataFrame:
    """bucket, l_0 .. l_D-1: smoothed log-likelihood of a word in each domain."""
    words = docs.filter(F.col(domain_col).isNotNull()).select(
        F.col(domain_col).cast("string").alias("d"), F.explode(_words(F.col(text_col))).alias("w"))
    counts = words.groupBy(_bucket(F.col("w")).alias("bucket")).agg(
        *[F.count(F.when(F.col("d") == d, 1)).alias(f"c_{i}") for i, d in enumerate(domains)])
    counts = materialize(counts, "word-counts")  # at most BUCKETS rows
    sums = counts.agg(*[F.coalesce(F.sum(f"c_{i}"), F.lit(0)) for i in range(len(domains))]).first()
    return counts.select("bucket", *[F.log((F.col(f"c_{i}") + 1) / (sums[i] + BUCKETS)).alias(f"l_{i}")
                                     for i in range(len(domains))])


def posteriors(docs: DataFrame, id_col: str, text_col: str, domain_col: str) -> tuple[DataFrame, list[str]]:
    """One row per document: id, sha (hash of the text), tokens, p_0 .. p_D-1."""
    found = (docs.groupBy(F.col(domain_col).cast("string").alias("d")).agg(F.count("*").alias("n"))
                 .filter("d is not null").orderBy("d").limit(MAX_DOMAINS + 1).collect())
    if len(found) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains in {domain_col}")
    domains = [r["d"] for r in found] or ["all"]
    prior = [r["n"] / sum(x["n"] for x in found) for r in found] or [1.0]
    k = range(len(domains))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("sha"),
                       _words(F.col(text_col)).alias("words"))
    # the row number counts documents, so it is drawn before the words are exploded
    rows = rows.select("row", "id", "sha", F.explode_outer("words").alias("w"))
    table = F.broadcast(word_table(docs, text_col, domain_col, domains))  # BUCKETS rows
    scored = (rows.withColumn("bucket", _bucket(F.col("w"))).join(table, "bucket", "left")
                  .groupBy("row")
                  .agg(F.first("id").alias("id"), F.first("sha").alias("sha"), F.count("w").alias("tokens"),
                       *[F.coalesce(F.sum(F.when(F.col("w").isNotNull(), F.coalesce(f"l_{i}", F.lit(0.0)))), F.lit(0.0))
                         .alias(f"s_{i}") for i in k]))
    weight = F.least("tokens", F.lit(EVIDENCE)) / F.greatest("tokens", F.lit(1))
    logit = scored.select("id", "sha", "tokens",
                          *[(F.log(F.lit(prior[i])) + F.col(f"s_{i}") * weight).alias(f"s_{i}") for i in k])
    top = F.greatest(*[F.col(f"s_{i}") for i in k]) if len(domains) > 1 else F.col("s_0")
    expd = logit.select("id", "sha", "tokens", *[F.exp(F.col(f"s_{i}") - top).alias(f"e_{i}") for i in k])
    whole = _total([F.col(f"e_{i}") for i in k])
    out = expd.select("id", "sha", "tokens", *[F.round(F.col(f"e_{i}") / whole, 9).alias(f"p_{i}") for i in k])
    return materialize(out, "posteriors"), domains


def fit_rates(post: DataFrame, n_domains: int, targets: list[float] | None = None,
              smoothing: float = SMOOTHING) -> Column:
    """The fitted rate as a column over ``post``.

    In the metric of the token counts one step is
    ``r <- max(0, r - (p . (W v) + ridge (r - 1)) / (1 + ridge))`` with v the present excess
    of each domain over its target share and W the inverse present shares, under which the
    step size 1 / (1 + ridge) never overshoots."""
    k = range(n_domains)
    rate = F.lit(1.0)

    def expected(r: Column) -> list[float]:
        row = post.agg(*[F.sum(r * F.col("tokens") * F.col(f"p_{i}")) for i in k]).first()
        return [float(x or 0.0) for x in row]

    present = expected(rate)
    total = sum(present)
    if not total:
        return rate
    shares = [x / total for x in present]
    if targets is None:
        targets = [s ** smoothing if s else 0.0 for s in shares]
    want = [t / sum(targets) for t in targets]
    got = shares
    for _ in range(STEPS):
        excess = [(g - w) / s if s else 0.0 for g, w, s in zip(got, want, shares)]
        if max(abs(g - w) for g, w in zip(got, want)) < TOLERANCE:
            break
        step = _total([F.lit(excess[i]) * F.col(f"p_{i}") for i in k])
        rate = F.greatest(F.lit(0.0), (rate + RIDGE - step) / (1 + RIDGE))
        got = [x / total for x in expected(F.when(F.col("tokens") > 0, rate).otherwise(1.0))]
    return F.when(F.col("tokens") > 0, rate).otherwise(1.0)


def copies_of(rate: Column, seed: int = 17) -> Column:
    """Whole copies whose expectation over documents is the rate."""
    chance = F.pmod(F.xxhash64(F.col("id").cast("string"), "sha", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(chance < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def document_rates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang",
                   targets: dict[str, float] | None = None, smoothing: float = SMOOTHING) -> DataFrame:
    """id, sha, tokens, domain (likeliest), posterior (its), rate, copies."""
    post, domains = posteriors(docs, id_col, text_col, domain_col)
    if targets is not None and set(targets) - set(domains):
        raise ValueError("targets name domains without documents")
    want = [targets.get(d, 0.0) for d in domains] if targets is not None else None
    k = range(len(domains))
    best = F.greatest(*[F.col(f"p_{i}") for i in k]) if len(domains) > 1 else F.col("p_0")
    name = F.coalesce(*[F.when(F.col(f"p_{i}") == best, F.lit(domains[i])) for i in k])
    out = post.withColumn("rate", F.round(fit_rates(post, len(domains), want, smoothing), 9))
    return out.select("id", "sha", "tokens", name.alias("domain"), best.alias("posterior"), "rate",
                      copies_of(F.col("rate")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang",
        targets: dict[str, float] | None = None, smoothing: float = SMOOTHING) -> DataFrame:
    """The documents, each as often as its copies say, with all their columns."""
    rates = document_rates(docs, id_col, text_col, domain_col, targets, smoothing)
    change = materialize(rates.filter("copies != 1").select(
        F.col("id").alias("__id"), F.col("sha").alias("__sha2"), "copies").distinct()
        .withColumnRenamed("copies", "__copies"), "copies")
    keyed = docs.withColumn("__sha", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = keyed.join(change, keyed[id_col].eqNullSafe(change["__id"]) & (F.col("__sha") == F.col("__sha2")), "left")
    times = F.coalesce(F.col("__copies"), F.lit(1))
    return (joined.filter(times > 0)
                  .withColumn("__nth", F.explode(F.sequence(F.lit(1), times)))
                  .select(*[docs[c] for c in docs.columns]))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens, likeliest language, fitted rate and copies."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    r = document_rates(docs)
    return r.select(F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"), "domain", "posterior", "rate", "copies")
