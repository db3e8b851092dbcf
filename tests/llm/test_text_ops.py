"""BPE, HTML extraction, WARC, n-gram join and language ID against independent versions."""

import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossa.llm import bpe, html_text, language_id, ngram_join, shingles, warc

DOCS = "doc_id long, text string, ids string, key long"


def _docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in texts], DOCS).repartition(3)


# -- BPE -------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def coders():
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(bpe.default_vocabulary())
    other.no_truncation()
    other.no_padding()
    return bpe.Bpe(bpe.default_vocabulary()), other


ODD = ["", " \n\t", "Don't I'LL we've", "aaaaaaaaaaaaa", "ΑΣ ΣΑΣ İstanbul ﬁ é", "x\x1cy\x85z​w　v",
       "a<|endoftext|>b <|STARTOFTEXT|><|startoftext|>", "12345 ½ ٣ ²", "中文 😀😀👩‍👩‍👧 ..!!??", "\0null", "co­op", "_a_"]


def _same(coders, texts):
    mine, other = coders
    ids, sizes = mine.encode(texts)
    at = 0
    for text, n, ref in zip(texts, sizes, other.encode_batch(texts, add_special_tokens=False)):
        own = ids[at:at + n].tolist()
        at += n
        assert own == ref.ids, text
        assert mine.decode(own) == other.decode(ref.ids, skip_special_tokens=False)


def test_bpe_odd_texts(coders):
    _same(coders, ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdeéßñ 'stremo12.,!?#中ά😀Σ́\n<|>_"), max_size=60), max_size=8))
def test_bpe_random_texts(coders, texts):
    _same(coders, texts)


def test_bpe_cache_restart(coders, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    for _ in range(3):
        _same(coders, ["one two three four five six seven", "eight nine", "one two"])
    coders[0].forget()


def test_bpe_operator(spark, coders):
    texts = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (51, "word " * 200_000), (51, "word " * 200_000)]
    rows = bpe.token_digests(_docs(spark, texts), ["doc_id"]).collect()
    assert len(rows) == len(texts)
    by = {r.doc_id: r for r in rows}
    for i, t in texts:
        ref = coders[1].encode(t or "", add_special_tokens=False)
        assert by[i].n_tokens == len(ref.ids)
        assert by[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ref.ids)).encode()).hexdigest()
        text = coders[1].decode(ref.ids, skip_special_tokens=False)
        assert by[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    split = bpe.decode(bpe.encode(_docs(spark, texts), ["doc_id"]), ["doc_id"])
    assert {r.doc_id: len(r.ids) for r in split.collect()} == {i: by[i].n_tokens for i, _ in texts}
    assert bpe.token_digests(_docs(spark, texts).limit(0), ["doc_id"]).count() == 0


# -- HTML ------------------------------------------------------------------------------------
def test_parse_broken_markup():
    page = ("<!DOCTYPE html><title>t</title><body><nav><ul><li>menu</ul></nav><article><h1>A &amp; B</h1>"
            "<p><b>one<br>two<p>three <a href='x>y'>four</a>\n five</b><div class=\"ad\">buy</div>"
            "<ul><li>x<li>y</ul><script>var a='</p>';</script><p>six &lt;7&gt; &am &copy;</article><footer>f")
    assert html_text.main_text(page, ()) == "A & B\n\none two\n\nthree four five\n\nx\n\ny\n\nsix <7> &am ©"


@pytest.mark.parametrize("page,text", [("", ""), ("plain  text", "plain text"), ("a < b and <c", "a < b and <c"),
                                       ("<p>x<!-- <p>y", "x"), ("<div><div><p>q</span></div>r", "q\n\nr"),
                                       ("<form>in</form>", ""), ("<p a='1>2\">x", "2\">x"),
                                       ("<body class='ad-page'><p>kept", "kept"),
                                       ("<article>x</article><p>comment", "x")])
def test_parse_odd_pages(page, text):
    assert html_text.main_text(page, ()) == text


def test_style_tree_finds_the_menu_of_a_site(spark):
    """Neutral elements: only their repetition over the site tells menu and legal line."""
    def page(i):
        return (f"<div class='xa'><ul><li>Home<li>News<li>Jobs</ul></div><div class='xb'><p>Text {i} tells of {i * 7}."
                f"<p>More on {i}.</div><div class='xc'>All rights reserved</div>")
    rows = [(i, "https://Site.org/a", page(i), "extra") for i in range(12)]
    rows += [(100, "http://two.org/", page(1), "extra"), (101, None, page(2), "extra"), (102, "http://two.org/x", None, "extra")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = {r.page_id: r for r in html_text.extract(pages).collect()}
    for i in range(12):
        assert got[i].text == f"Text {i} tells of {i * 7}.\n\nMore on {i}."
        assert got[i].n_chars == len(got[i].text)
    assert "All rights reserved" in got[100].text and "More on 1." in got[100].text  # one page tells nothing
    assert got[102].text == "" and got[101].text and got[101].url is None
    assert html_text.extract(pages.limit(0)).count() == 0


def test_copied_article_stays(spark):
    rows = [(i, "http://s.org/", "<nav>m</nav><article><p>same text</article>") for i in range(8)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in out.collect()} == {"same text"}


@pytest.mark.parametrize("page,text", [
    ("<div class='has-sidebar'><article>x</article></div>", "x"),
    ("<body id='no-sidebar'><div id='content-with-ads'><p>x</div><div class='ad'>y</div>", "x"),
    ("<div class='banner'><div class='widget-3'><p>menu</div><main><p>x</main></div>", "x"),
    ("<article><p>x<div class='comments'>y</div></article>", "x")])
def test_wrapper_named_by_a_noise_word(page, text):
    assert html_text.main_text(page, ()) == text


def test_tree_decides_inside_and_beside_articles(spark):
    """A promo inside every article goes; a site's own text beside a teaser article stays."""
    rows = [(i, "http://a.org/", f"<article><h1>T {i}</h1><p>Text {i}.<div class=xp><p>Try it free</div></article>"
                                 "<div class=xm>Home</div>") for i in range(8)]
    rows += [(100 + i, "http://b.org/", f"<div class=xt><p>Story {i}.</div><article><p>Teaser {i}</article>"
                                        "<div class=xm>Home</div>") for i in range(8)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    got = {r.page_id: r.text for r in out.collect()}
    assert got == {**{i: f"T {i}\n\nText {i}." for i in range(8)},
                   **{100 + i: f"Story {i}.\n\nTeaser {i}" for i in range(8)}}


@pytest.mark.parametrize("page,text", [
    ("<article><p>x<span class='ad'>buy <span>now</span> cheap</span> y</article>", "x y"),
    ("<article><p>x<span class='ad'>buy <b>now</span> y</article>", "x y"),
    ("<article><p>x</p><ul class='comment-list'><li>first</ul></article>", "x"),
    ("<article><p>x</p><div class='reader-comments'><p>first</div></article>", "x"),
    ("<article><p>x</p><div id=disqus_thread>first</div></article>", "x"),
    ("<div class='main-nav'>Home</div><p>x</p><div class='cookie-notice'>c</div><div id='site-footer'>f</div>", "x"),
    ("<p hidden>h</p><div style='color:red; display: none'>d</div><p class='hidden x'>x", "x"),
    ("<article><div class='entry-header'><h1>T</h1></div><pre>a <span class='comment'># b</span></pre></article>",
     "T\n\na # b"),
    ("<div class='no-sidebar'><p>x</p></div><div class='related-layout'><p>y</div>", "x\n\ny"),
    ("<article>" + "<p>word & word</p>" * 50_000 + "</article>", "\n\n".join(["word & word"] * 50_000))])
def test_noise_named_by_part_of_a_class(page, text):
    assert html_text.main_text(page, ()) == text


def test_article_keeps_what_its_site_repeats(spark):
    """Headings and lead lines equal on all pages are text; repeated links inside are not."""
    def page(i):
        return (f"<article><p class=lead>Good food.</p><h1>Dish {i}</h1><h2>Ingredients</h2><ul><li>Salt {i}</ul>"
                f"<div class=xr><a href=/a>More dishes</a></div><h2>Method</h2><p>Cook {i}.</article>")

    def bare(i):
        return f"<div class=xb><h2>Ingredients</h2><p>Salt {i}.<h2>Method</h2><p>Cook {i}.</div><div class=xm><h3>See</h3>Jobs</div>"
    rows = [(i, "http://a.org/", page(i)) for i in range(12)] + [(100 + i, "http://b.org/", bare(i)) for i in range(12)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    got = {r.page_id: r.text for r in out.collect()}
    for i in range(12):
        assert got[i] == f"Good food.\n\nDish {i}\n\nIngredients\n\nSalt {i}\n\nMethod\n\nCook {i}."
        assert got[100 + i] == f"Ingredients\n\nSalt {i}.\n\nMethod\n\nCook {i}."


def test_importance_against_one_tree_in_memory(spark):
    """Noise and known branches of random sites against entropies summed page by page."""
    rng = random.Random(5)
    rows = []
    for i in range(60):
        parts = [f"<div class=c{c}><p>{rng.choice(['same', 'alike', f'own {i} {c}'][:rng.randint(1, 3)])}</p></div>"
                 for c in "abcde" if rng.random() < 0.8]
        rows.append((i, f"http://h{i % 3}.org/{i}", f"<div class=n>{i}</div>" + "".join(parts)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    seen: dict = {}
    for _, url, page in rows:
        host, (blocks, styles) = html_text.host_of(url), html_text.parse(page)
        feats = {("block", p, t) for p, prior, t, _ in blocks if prior}
        nodes = {a for _, p, _ in feats for a in html_text._ancestors(p)}
        by_path: dict = {}
        for p, children in styles:
            by_path.setdefault(p, []).append(tuple(children))
        feats |= {("style", p, tuple(s)) for p, s in by_path.items() if p in nodes} | {("page", p, "") for p in nodes}
        for f in feats:
            seen[(host, *f)] = seen.get((host, *f), 0) + 1
    want: dict = {}
    for (host, kind, node, _), m in seen.items():
        if kind != "page" or m < html_text.MIN_PAGES:
            continue
        h = w = shown = 0.0
        for (other, k, p, _), n in seen.items():
            if other == host and k == "block" and (p + "/").startswith(node + "/") and seen[(host, "page", p, "")] >= html_text.MIN_PAGES:
                h += n * math.log(n) / math.log(seen[(host, "page", p, "")])
                w += n
            elif other == host and k == "style" and p == node:
                shown -= n / m * math.log(n / m) / math.log(m)
        if w and html_text.GAMMA * (1 - h / w) + (1 - html_text.GAMMA) * shown < html_text.THRESHOLD:
            want.setdefault(host, set()).add(node)
    got = {r.host: set(r.branches) for r in html_text.noise_branches(html_text.style_trees(pages)).collect()}
    assert {h: b for h, b in got.items() if b} == want and want


def test_copies_of_a_page_count_once(spark):
    """A group of copies, told apart by their navigation only, makes nine tenths of a host."""
    def page(i, nav):
        return (f"<nav>{nav}</nav><div class='xa'><ul><li>Home<li>Jobs</ul></div>"
                f"<div class='xb'><p>Text {i} of its own.<p>More on {i}.</div>")
    rows = [(j, "http://s.org/", page(0, j % 9)) for j in range(40)] + [(100 + i, "http://s.org/", page(i, 0)) for i in range(1, 5)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    for r in out.collect():
        i = max(r.page_id - 100, 0)
        assert r.text == f"Text {i} of its own.\n\nMore on {i}."


# -- WARC ------------------------------------------------------------------------------------
PAGES = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "u v\n", ""),
         (5, "http://a/5", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (6, "é", "ü 😀 " * 50_000), (None, "http://a/n", "same"),
         (7, "http://a/7", "xy"), (8, "http://a/8", "xy")]


def _warc(spark, tmp_path, min_bytes=0):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")
    path = str(tmp_path / f"warc{min_bytes}")
    warc.write_archives(pages.repartition(3), path, min_bytes=min_bytes)
    return path


def _digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 3])
def test_warc_round_trip(spark, tmp_path, min_bytes):
    path = _warc(spark, tmp_path, min_bytes)
    got = Counter(tuple(r) for r in warc.resolved_records(warc.read_records(spark, path)).collect())
    first, expected = {}, Counter()
    for i, _, t in sorted(PAGES, key=lambda p: (p[0] is None, p[0])):
        data = (t or "").encode()
        seen = first.setdefault(data, i) if len(data) >= min_bytes else None
        plain = len(data) < min_bytes or (seen == i and not first.get((data, "written")))
        first[data, "written"] = True
        expected[i, len(data), _digest(t), "response" if plain else "revisit", None if plain else seen] += 1
    assert got == expected


def test_warc_payloads_and_headers(spark, tmp_path):
    path = _warc(spark, tmp_path)
    rows = warc.read_records(spark, path, with_payload=True).filter("record_type = 'response'").collect()
    assert {r.page_id: r.payload.decode() for r in rows}[6] == "ü 😀 " * 50_000
    records = [h for f in (tmp_path / "warc0").glob("part-*.gz")
               for h, _ in warc.parse_archive(gzip.decompress(f.read_bytes()))]
    ids = {h[b"WARC-Record-ID"] for h in records}
    assert len(ids) == len(PAGES)
    for h in records:
        assert b"\n" not in h.get(b"WARC-Target-URI", b"")
        if h[b"WARC-Type"] == b"revisit":
            assert h[b"WARC-Refers-To"] in ids and h[b"WARC-Profile"] == warc.PROFILE.encode()
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(empty, str(tmp_path / "none"))
    assert warc.resolved_records(warc.read_records(spark, str(tmp_path / "none"))).count() == 0


# -- n-gram join -----------------------------------------------------------------------------
def word_set(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall("[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts, percent=75):
    """doc_id -> (set size, least id reachable), over all pairs that share a shingle."""
    sets = {i: word_set(t) for i, t in texts}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def _near_texts():
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(200)]
    line = [rnd.choice(vocab) for _ in range(40)]
    base = [[rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 5, 7, 8, 9, 10, 13, 20, 40, 90, 200]))] for _ in range(40)]
    texts = []
    for i in range(260):
        w = list(rnd.choice(base)) + (line if i % 3 == 0 else [])
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            p = rnd.randrange(len(w))
            w[p:p + 1] = rnd.choice([[rnd.choice(vocab)], [], [w[p], "new"]]) or [w[p]]
        texts.append((i, " ".join(w).upper() if i % 7 == 0 else "\n".join(w)))
    return texts + [(900, None), (901, ""), (902, "  \t"), (903, "x"), (904, "X"), (905, "A b c d e")]


def test_join_against_all_pairs(spark, monkeypatch):
    """Small groups and frequent shingles, so that every path of the search runs."""
    for name, value in (("GROUP", 12), ("LEADERS", 6), ("FREQUENT", 16)):
        monkeypatch.setattr(ngram_join, name, value)
    texts = _near_texts()
    rows = ngram_join.link_documents(_docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)


def test_join_small_tables(spark):
    same = [(5, "a b c d e f"), (3, "a  b c d e F"), (9, "A b c d e f"), (9, "A b c d e f")]
    rows = ngram_join.link_documents(_docs(spark, same)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(3, 2, 3), (5, 2, 3), (9, 2, 3), (9, 2, 3)]
    assert ngram_join.link_documents(_docs(spark, same).limit(0)).count() == 0
    kept = ngram_join.keep_one_per_group(_docs(spark, same[:3] + [(12, None)]))
    assert kept.columns == ["doc_id", "text", "ids", "key"] and sorted(r.doc_id for r in kept.collect()) == [3, 12]


@settings(max_examples=200, deadline=None)
@given(st.integers(3, 400), st.integers(0, 200), st.integers(0, 200), st.integers(0, 2**32), st.booleans())
def test_linked_sets_share_a_signature(n, drop, add, seed, frequent):
    """The guarantee behind the join, with arbitrary frequency classes."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, n, np.uint64))
    b = np.unique(np.append(a[min(drop, a.size):], rng.integers(0, 2**64, add, np.uint64)))
    common = np.intersect1d(a, b).size
    if b.size < 3 or 100 * common < 75 * (a.size + b.size - common):
        return
    level = (lambda s: (s % np.uint64(3)).astype(np.uint8)) if frequent else (lambda s: np.zeros(s.size, np.uint8))
    (sa, wa), (sb, wb) = (ngram_join.signatures(s, level(s)) for s in (a, b))
    least = {int(x): int(w) for x, w in zip(sb, wb)}
    shared = [int(x) for x, w in zip(sa, wa) if int(x) in least and int(w) + least[int(x)] <= 0]
    assert shared
    need = min(ngram_join._least_emitted(a), ngram_join._least_emitted(b)) - (a.size + b.size) // 7
    both = np.intersect1d(sa, sb).size
    assert ngram_join._least_emitted(a) < 0 or ngram_join._least_emitted(b) < 0 or both >= need


def _passage_pairs(pairs=8, others=40):
    """Pairs of 200 shingles each: 165 of a passage that all hold, 10 rare ones in common, 25 own
    (J = 0.778).  The others link with nobody."""
    def own(tag, n):
        return [f"{tag}x{j}" for j in range(n)]
    passage = own("p", 169)
    texts = [(100 + 2 * i + side, passage + own(f"c{i}", 10) + own(f"d{i}s{side}", 25))
             for i in range(pairs) for side in (0, 1)]
    texts += [(1000 + i, passage + own(f"o{i}", 60)) for i in range(others)]
    return [(i, " ".join(w)) for i, w in texts]


def test_join_around_a_frequent_passage(spark):
    """The frequent parts of such a pair are no meetings; its rare ones must do."""
    assert ngram_join.FREQUENT == 32
    texts = _passage_pairs()
    expected = brute_components(texts)
    assert expected[101] == (200, 100)
    rows = ngram_join.link_documents(_docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected


def test_members_that_link_with_nobody(spark, monkeypatch):
    """A passage held by texts of which only few link: sketches keep the others apart, whether
    their group is searched in full or by leaders."""
    texts = _passage_pairs(pairs=6, others=150)
    expected = brute_components(texts)
    for size in (512, 32):
        monkeypatch.setattr(ngram_join, "GROUP", size)
        monkeypatch.setattr(ngram_join, "LEADERS", size)
        rows = ngram_join.link_documents(_docs(spark, texts)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected


def test_crowds_join_before_their_pairs_are_formed(spark, monkeypatch):
    """Near copies of which each links with about half of the others: no single leader
    links them all, but few members do, so most pairs are never formed."""
    rnd = random.Random(4)
    lines = [" ".join(f"w{i}x{j}" for j in range(9)) for i in range(40)]
    texts = []
    for i in range(70):
        own = list(lines)
        for at in rnd.sample(range(len(lines)), 2):
            own[at] = " ".join(f"o{i}a{at}b{j}" for j in range(9))
        texts.append((i, " ".join(own)))
    monkeypatch.setattr(ngram_join, "FREQUENT", 1000)
    made = Counter()

    def counted(df, name, *more):
        out = materialize(df, name, *more)
        made[name] += out.count() if name == "pairs" else 0
        return out

    materialize = ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", counted)
    rows = ngram_join.link_documents(_docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)
    assert made["pairs"] < 1000  # of 2,415


def test_small_crowds_against_all_pairs(spark, monkeypatch):
    for name, value in (("CROWD", 3), ("HEADS", 2), ("GROUP", 12), ("LEADERS", 6), ("FREQUENT", 16)):
        monkeypatch.setattr(ngram_join, name, value)
    texts = _near_texts()
    rows = ngram_join.link_documents(_docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_components(texts)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 300), st.integers(0, 300), st.integers(0, 2**32))
def test_sketches_differ_in_no_more_bits_than_sets(n, drop, add, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, n, np.uint64))
    b = np.unique(np.append(a[min(drop, a.size):], rng.integers(0, 2**64, add, np.uint64)))
    x, y = ngram_join.parity_sketch(a), ngram_join.parity_sketch(b)
    assert x.size == len(ngram_join.SKETCH)
    assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= np.setxor1d(a, b).size


@settings(max_examples=200, deadline=None)
@given(st.integers(12, 400), st.integers(0, 60), st.integers(0, 60), st.floats(0, 1), st.integers(0, 2**32))
def test_linked_sets_meet_often_enough(n, drop, add, hot, seed):
    """The number of meetings that is asked for, counting only those the slack allows."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**64, n, np.uint64))
    b = np.unique(np.append(a[min(drop, a.size):], rng.integers(0, 2**64, add, np.uint64)))
    common = np.intersect1d(a, b).size
    if b.size < 3 or 100 * common < 75 * (a.size + b.size - common):
        return
    levels = [((s >> np.uint64(3)) % np.uint64(1000) < np.uint64(int(1000 * hot))).astype(np.uint8) for s in (a, b)]
    (sa, wa), (sb, wb) = (ngram_join.signatures(s, x) for s, x in zip((a, b), levels))
    least = {int(x): int(w) for x, w in zip(sb, wb)}
    c = sum(int(x) in least and int(w) + least[int(x)] <= 0 for x, w in zip(sa, wa))
    emitted = min(ngram_join._least_emitted(a), ngram_join._least_emitted(b))
    slack = sum(ngram_join._hot_slack(s, x) for s, x in zip((a, b), levels))
    assert emitted < 0 or c >= emitted - (a.size + b.size) // 7 or (slack > 0 and 350 * c >= slack)


def test_shingle_sets_are_exact():
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice("aB cC dd É e\t").strip() or "\n" for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    texts += [None, "", "one", "one two three four", "é" * 70_000 + " x" * 70_000]
    assert [s.size for s in shingles.shingle_sets(texts)] == [len(word_set(t)) for t in texts]
    a, b = shingles.shingle_sets(["a b c d e f g", "x a B c d e f"])
    assert np.intersect1d(a, b).size == len(word_set("a b c d e f g") & word_set("x a B c d e f"))


# -- language ID -----------------------------------------------------------------------------
def _languages(n=240):
    rnd = random.Random(4)
    parts = {"aa": ["kat", "ruk", "ola", "pim"], "bb": ["schei", "ung", "ver", "ö"], "cc": ["ción", "que", "los", "ñ"]}
    out = []
    for i in range(n):
        lang = rnd.choice(list(parts))
        out.append((i, " ".join("".join(rnd.choice(parts[lang]) for _ in range(rnd.randint(1, 3)))
                                for _ in range(rnd.randint(1, 40))), lang))
    return out


def test_language_id_held_out_accuracy(spark):
    rows = _languages() + [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !?", None), (1003, "kat ruk", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    train = docs.filter(~language_id.held_out(F.col("doc_id")))
    model = language_id.fit(train)
    out = {r.doc_id: r for r in language_id.predict(docs.withColumn("score", F.lit(9)), model, ["doc_id"]).collect()}
    import zlib
    truth = {i: lang for i, _, lang in rows[:240] if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(truth) > 30 and np.mean([out[i].lang_pred == lang for i, lang in truth.items()]) > 0.97
    assert all(0 <= r.score <= 1 for r in out.values())
    assert [(out[i].lang_pred, out[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert out[1003].lang_pred == "aa"
    assert (model[1] != 0).mean() < 0.2  # the l1 penalty keeps weights sparse


def test_document_frequencies_and_sample_bound(spark):
    docs = spark.createDataFrame(_languages(60), "doc_id long, text string, lang string").repartition(4)
    df = {r.feature: r.df for r in language_id.document_frequencies(docs).collect()}
    expected = Counter()
    for f in language_id._per_text([t for _, t, _ in _languages(60)]):
        expected.update(set(f.tolist()))
    assert df.pop(-1) == 60 and df == expected
    assert len(language_id.training_sample(docs, "doc_id", "text", "lang", max_rows=7)) == 7


def test_rare_language_is_in_the_sample(spark):
    rows = [(i, t, lang) for i, t, lang in _languages(400)] + [(9000 + i, "zhu wy xo " * 5, "zz") for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = language_id.training_sample(docs, "doc_id", "text", "lang", max_rows=20)
    assert len(got) == 20 and sum(r[0] == "zz" for r in got) == 2


def test_language_id_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    row = language_id.predict(docs, language_id.fit(docs), ["doc_id"]).first()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language_id.accept(docs.limit(0)).count() == 0
    kept = language_id.accept(spark.createDataFrame(
        [(i, t, lang, 1.5) for i, t, lang in _languages(80)] + [(500, "33", "aa", 0.0)],
        "doc_id long, text string, lang string, score double"))
    assert kept.columns == ["doc_id", "text", "lang", "score"] and kept.filter("doc_id = 500").count() == 0
    assert kept.count() >= 78
