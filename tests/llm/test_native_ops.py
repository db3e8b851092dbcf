"""Exact dedup, sharding, URL filter, fingerprints and mixing against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm import exact_dedup, fingerprints, mixing, sharding, url_filter

DOCS = "doc_id long, text string, lang string, kept boolean, slot int"


def _docs(spark, rows):
    """Documents with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, t, lang, True, 7) for i, t, lang in rows], DOCS).repartition(3)


MIXED = [(1, "a b", "en"), (2, "a b", "en"), (3, None, None), (4, "", "de"), (5, "a  b", "en"),
         (6, "a b", "fr"), (6, "a b", "fr"), (7, "x" * 300_000, "en"), (None, "a b", "en")]


# -- exact dedup -----------------------------------------------------------------------------
@pytest.mark.parametrize("bits,capacity", [(64, 4096), (64, 1), (2, 2)])
def test_exact_dedup_against_grouping(spark, bits, capacity):
    """Two hash bits force collisions: distinct texts chain in one bucket."""
    rows = MIXED + [(100 + i, f"text {i % 17}", "en") for i in range(80)]
    got = exact_dedup.exact_dedup(_docs(spark, rows), capacity=capacity, max_depth=6, key_bits=bits).collect()
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    expected = Counter()
    for i, t, _ in rows:
        keep = max(x for x in groups[t or ""] if x is not None)
        expected[i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == expected
    if bits == 2:
        assert max(r.chain for r in got) >= 3


def test_directory_splits_only_full_buckets(spark):
    """Nearly all keys share their first five bits, so only that side of the directory
    deepens; every bucket ends within its capacity."""
    keys = spark.createDataFrame([(i << 53,) for i in range(64)] + [((i << 58) - (1 << 63),) for i in range(4)],
                                 "key long")
    directory, depth = exact_dedup.build_directory(keys, capacity=16, max_depth=10)
    rows = directory.collect()
    assert len(rows) == 1 << depth and depth == 7
    local = {r.local_depth for r in rows}
    assert min(local) == 1 and max(local) == depth  # the sparse side kept one bit
    owned = exact_dedup._owned(keys, directory, depth).groupBy("bucket").count().collect()
    assert max(r["count"] for r in owned) <= 16


def test_keep_one(spark):
    out = exact_dedup.keep_one(_docs(spark, MIXED))
    assert out.columns == ["doc_id", "text", "lang", "kept", "slot"]
    assert sorted(r.doc_id for r in out.collect()) == [4, 5, 6, 7]
    assert exact_dedup.keep_one(_docs(spark, [(1, "a", "en")]).limit(0)).count() == 0


# -- sharding --------------------------------------------------------------------------------
def test_lookup_table_turns():
    """Shards claim in turn, so shares differ by one slot; a removed shard's slots move,
    few of the others do."""
    full = sharding.lookup_table(sharding.SHARDS, 6553)
    counts = Counter(full)
    assert set(counts) == set(range(64)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.lookup_table(sharding.SHARDS[:-1], 6553)
    moved = sum(a != b for a, b in zip(full, fewer) if a != 63)
    assert moved < 0.25 * 6553
    for bad in ((("a", "b"), 9), (("a", "a"), 7), ((), 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_placement(spark):
    out = sharding.place(_docs(spark, MIXED), "doc_id")
    table = sharding.lookup_table()
    rows = out.collect()
    assert len(rows) == len(MIXED) and "lang" in out.columns
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.TABLE_SIZE
        assert (r.slot, r.shard) == (slot, sharding.SHARDS[table[slot]])
    assert sharding.place(_docs(spark, MIXED).limit(0), "doc_id").count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan


def test_write_shards(spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(_docs(spark, MIXED), path, "doc_id", files_per_shard=2)
    back = spark.read.parquet(path)
    assert back.count() == len(MIXED)
    expected = {(r.doc_id, r.shard) for r in sharding.place(_docs(spark, MIXED), "doc_id").collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == expected


# -- URL filter ------------------------------------------------------------------------------
URLS = ["http://Www.Example.com/en/1", "http://example.com/en/1?x=/y", "https://a.example.com/en",
        "ftp://x.net/es/2#z", "http://x.net/esx", "no url", None, "", "://", "http://net/fr/", "http://h.com?q",
        "http://other.org/path", "http://notexample.com/en/", "http://x.netx/es/"]


def _rule(host, path):
    best = None
    for v, h, p in url_filter.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (not best or len(h + p) > len(best[1])):
            best = (v, h + p)
    return best or (None, None)


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, rule string")
    outcomes = spark.createDataFrame([], "host string, bad int")
    rows = {r.page_id: r for r in url_filter.filter_urls(pages, outcomes).collect()}
    assert len(rows) == len(URLS)
    for i, u in enumerate(URLS):
        host = path = ""
        if u and "://" in u:
            rest = u[u.index("://") + 3:].split("#")[0].split("?")[0]
            host, _, path = rest.partition("/")
            host, path = host.lower(), "/" + path if "/" in rest else ""
        verdict, rule = _rule(host, path)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == (verdict or "allow") and rows[i].bad_bound == 0.0


def test_reputation_shrinks_towards_parents(spark):
    """Many bad labels block a host; one bad label on a clean domain doesn't."""
    outcomes = ([("bad.evil.xyz", 1)] * 60 + [("new.evil.xyz", 1)] + [("worse.evil.xyz", 1)] * 40
                + [(f"h{i}.good.org", 0) for i in range(30) for _ in range(10)] + [("h0.good.org", 1)]
                + [("one.good.org", 1)])
    pages = spark.createDataFrame([(i, f"http://{h}/a") for i, h in enumerate(
        ["bad.evil.xyz", "new.evil.xyz", "unseen.evil.xyz", "h0.good.org", "one.good.org", "far.away.io"])],
        "page_id long, url string")
    got = [r.verdict for r in url_filter.filter_urls(
        pages, spark.createDataFrame(outcomes, "host string, bad int")).orderBy("page_id").collect()]
    assert got == ["block", "block", "block", "allow", "allow", "allow"]


# -- fingerprints ----------------------------------------------------------------------------
def test_fingerprints_against_definition(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", 400)
    words = [f"w{i}" for i in range(40)]
    rng = np.random.default_rng(3)
    texts = {i: " ".join(rng.choice(words, rng.integers(0, 30))) for i in range(0, 90, 3)}
    texts |= {7: None, 8: "", 11: "näïve 😀 tëxt", 12: "Only Four words here"}
    docs = _docs(spark, [(i, t, "en") for i, t in texts.items()])
    rows = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    assert rows.keys() == texts.keys()
    order = sorted(texts)
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    edited = {}
    for i, nxt in zip(order, order[1:] + order[:1]):
        a, b = texts[i] or "", texts[nxt] or ""
        half = len(a) // 2
        edited[i] = a[:len(a) - half] + b[:half]
        r = rows[i]
        assert r.n_chars == len(a) and r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert r.fingerprint == plain[i]
        differ = bin(int(plain[i], 16) ^ int(plain[nxt], 16)).count("1")
        assert r.near_next == pytest.approx(1 - differ / 128)
        differ = bin(int(r.fingerprint, 16) ^ int(r.edited_fingerprint, 16)).count("1")
        assert r.near_edited == pytest.approx(1 - differ / 128)
    # a fingerprint is the majority vote of its shingles' bits
    of_edited = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(
        _docs(spark, [(i, t, "en") for i, t in edited.items()])).collect()}
    assert all(rows[i].edited_fingerprint == of_edited[i] for i in order)
    assert rows[7].fingerprint == rows[8].fingerprint == "0" * 32


def test_fingerprint_is_a_majority_vote(spark):
    """Votes recomputed in Python from single-shingle fingerprints."""
    text = "a b c d e f g h a b c d e"
    words = text.split()
    shingles = [" ".join(words[i:i + 5]) for i in range(len(words) - 4)]
    one = {r.text: int(r.fingerprint, 16) for r in fingerprints.fingerprints(
        spark.createDataFrame([(s, s) for s in set(shingles)], "doc_id string, text string"))
        .withColumnRenamed("doc_id", "text").collect()}
    bits = 0
    for b in range(128):
        votes = sum(1 if one[s] >> b & 1 else -1 for s in shingles)
        bits |= (votes > 0) << b
    whole = fingerprints.fingerprints(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert int(whole.fingerprint, 16) == bits


def test_within_radius_finds_all(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-2**63, 2**63, (40, 2), np.int64)
    near = base.copy()
    for row in near:
        for bit in rng.choice(128, rng.integers(0, 6), replace=False):
            row[bit // 64] ^= np.int64(1) << np.int64(bit % 64)
    values = [(int(a), int(b)) for a, b in np.vstack([base, near])]
    df = spark.createDataFrame(values, "f0 long, f1 long")
    got = {(r.q, r.p, r.distance) for r in fingerprints.within_radius(df, df, 3).collect()}
    mask = (1 << 64) - 1
    codes = sorted({((a & mask) << 64) | (b & mask) for a, b in values})
    expected = {(f"{x:032x}", f"{y:032x}", bin(x ^ y).count("1")) for x in codes for y in codes
                if 0 < bin(x ^ y).count("1") <= 3}
    assert got == expected and expected


def test_near_counts_against_all_pairs(spark):
    """Long texts of which one or two words differ, copies, repeated and null ids."""
    rng = np.random.default_rng(3)
    rows = [(None, "a b"), (0, None), (20, ""), (40, "x y"), (40, "x y"), (60, "w " * 30_000)]
    for group in range(6):
        words = [f"w{x}" for x in rng.integers(0, 5_000, 3_000)]
        for copy in range(12):
            own = list(words)
            for at in rng.choice(len(words), copy % 4, replace=False):
                own[at] = f"n{copy}"
            rows.append((100 + 20 * len(rows) if copy % 3 else 7, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prints = fingerprints.edited_fingerprints(docs)
    got = fingerprints.near_counts(prints, F.col("doc_id") % 20 == 0).collect()
    codes = {int(r.fingerprint, 16) for r in got}
    assert len(got) == len(rows)
    for r in got:
        code = int(r.fingerprint, 16)
        want = sum(0 < (code ^ c).bit_count() <= 3 for c in codes)
        assert r.near_prints == (want if r.doc_id is not None and r.doc_id % 20 == 0 else None)
    assert max(r.near_prints or 0 for r in got) > 1
    assert fingerprints.near_counts(prints.limit(0), F.col("doc_id") % 20 == 0).count() == 0


def test_single_document_and_empty_table(spark):
    one = fingerprints.edited_fingerprints(_docs(spark, [(5, "a b c d e f", "en")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"a b c " + b"a b c").hexdigest()
    assert one.n_chars == 11 and one.near_next == 1.0
    assert fingerprints.edited_fingerprints(_docs(spark, MIXED).limit(0)).count() == 0


# -- mixing ----------------------------------------------------------------------------------
def _corpus():
    rng = np.random.default_rng(9)
    vocab = {d: [f"{d}{i}" for i in range(60)] for d in ("de", "en", "fr")}
    rows = []
    for i in range(400):
        d = rng.choice(["en", "de", "fr"], p=[0.7, 0.2, 0.1])
        words = [str(rng.choice(vocab[d if rng.random() < 0.9 else "en"])) for _ in range(rng.integers(5, 60))]
        rows.append((i, " ".join(words), str(d) if i % 5 else None))
    return rows + [(900, None, "en"), (901, "", None), (902, rows[3][1], "fr")]


def test_mixing_meets_targets(spark):
    docs = _docs(spark, _corpus())
    targets = {"en": 1.0, "de": 1.0, "fr": 2.0}
    rates = mixing.document_rates(docs, targets=targets)
    rows = rates.collect()
    assert len(rows) == 403 and all(r.rate >= 0 for r in rows)
    post, domains = mixing.posteriors(docs, "doc_id", "text", "lang")
    p = {(r.id, r.sha): [r[f"p_{i}"] for i in range(3)] for r in post.collect()}
    assert domains == ["de", "en", "fr"]
    got = np.zeros(3)
    for r in rows:
        assert sum(p[r.id, r.sha]) == pytest.approx(1, abs=1e-6)
        got += r.rate * r.tokens * np.array(p[r.id, r.sha])
    assert got / got.sum() == pytest.approx([0.25, 0.25, 0.5], abs=2e-3)
    by = {r.id: r for r in rows}
    assert by[900].tokens == 0 and by[900].rate == 1.0 and by[901].copies == 1
    assert all(abs(r.copies - r.rate) < 1 for r in rows)
    with pytest.raises(ValueError):
        mixing.document_rates(docs, targets={"xx": 1.0})


def test_mixing_rates_match_dense_solver(spark):
    """The same projected gradient over a dense matrix in numpy."""
    docs = _docs(spark, _corpus())
    post, domains = mixing.posteriors(docs, "doc_id", "text", "lang")
    rows = post.collect()
    p = np.array([[r[f"p_{i}"] for i in range(3)] for r in rows])
    tok = np.array([r.tokens for r in rows], float)
    share = (tok[:, None] * p).sum(0) / tok.sum()
    want = share ** mixing.SMOOTHING / (share ** mixing.SMOOTHING).sum()
    rate, got = np.ones(len(rows)), share
    for _ in range(mixing.STEPS):
        if np.abs(got - want).max() < mixing.TOLERANCE:
            break
        rate = np.maximum(0, (rate + mixing.RIDGE - p @ ((got - want) / share)) / (1 + mixing.RIDGE))
        got = (np.where(tok > 0, rate, 1)[:, None] * tok[:, None] * p).sum(0) / tok.sum()
    out = {(r.id, r.sha): r.rate for r in mixing.document_rates(docs).collect()}
    for r, x, t in zip(rows, rate, tok):
        assert out[r.id, r.sha] == pytest.approx(x if t else 1.0, abs=1e-6)


def test_mix_copies_rows(spark):
    docs = _docs(spark, _corpus()).withColumn("copies", F.lit("mine"))
    rates = {r.id: r.copies for r in mixing.document_rates(docs).collect()}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: c for i, c in rates.items() if c})
    empty = docs.limit(0)
    assert mixing.mix(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert mixing.mix(unlabelled).count() == 403

