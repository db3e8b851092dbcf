"""Main text of web pages by site style trees.

Pass 1 parses every page and merges the DOMs of a host into one tree: a node is a path of
block elements with their classes.  Per node it counts pages, the presentation styles
(sequences of child elements) and the content blocks.  Pages of a host with the same open
blocks count once: each of c copies adds ``ONE // c`` to the counts.  These counts are combined in each
task and again by Spark, so a hot host costs one row per task and distinct count.

A node seen on m pages has

* content importance ``1 - mean over its blocks' occurrences of ln(n) / ln(m)`` for a
  block on n of the m pages: the entropy of a feature spread over n pages, relative to
  the most that m pages allow.  A menu that repeats everywhere has importance 0, text of
  its own 1.  A branch takes the mean over all blocks below it;
* presentation importance: the entropy of its styles over the m pages, relative to ln(m).

A branch is noise when ``GAMMA * content + (1 - GAMMA) * presentation`` is below
``THRESHOLD`` on at least ``MIN_PAGES`` pages.  Elements that never hold an article
(navigation, forms, scripts, hidden elements, classes such as ``ad`` or ``reader-comments``
around no article) have prior importance 0, and
branches inside ``article`` / ``main`` have prior importance 1 with weight ``ARTICLE``; the
element itself is never noise, so that an article copied over a whole site isn't taken for a
menu.

Pass 2 joins each host's noise branches to its pages and extracts the rest.  Low importance
alone takes nothing out of an article: headings and lead lines that a site repeats are its
text.  There a second sign must come to it: most of the block is link text, or the branch is a
``div`` or ``section`` of its own after all other text of the article.  A heading (h1 to h6) goes only with the branch that it heads.  Beside an
article stays what the tree knows to be of high importance; branches seen on fewer than
``MIN_PAGES`` pages are no part of the article.

Defined results: a null or empty page has empty text; broken markup is read as browsers
do in outline (unclosed and stray tags, missing end); a page without url belongs to the
host ''; if nothing but noise remains, the article's blocks are the text, without an article all
blocks without prior importance 0;
repeated rows repeat; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MIN_PAGES = 3
THRESHOLD = 0.3
GAMMA = 0.9
#: Weight of the prior importance 1 inside an article.
ARTICLE = 0.2
#: Distinct counts a task holds before it passes them on.
HELD = 100_000
#: A page's count, a whole number, so that the order of adding up changes nothing.
ONE = 1 << 36

# fixed values: HTML element kinds
_RAW = frozenset("script style noscript template textarea title iframe xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
                    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_NEVER = frozenset("nav footer aside form head button select option input dialog menu svg canvas object video "
                   "audio map".split()) | _RAW
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                      "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
# fixed values: class or id words of boilerplate
_NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                         "cookie cookies consent disclaimer disqus footer header login menu modal nav navbar navigation "
                         "newsletter notice notices popup promo promotion related respond share sharing sidebar signup "
                         "social sponsor sponsored subscribe subscription toolbar widget".split())
# fixed values: words beside them that name a wrapper or a part of the article
_WRAPPER_WORDS = frozenset("has no with without layout content page body wrap wrapper container".split())
_TITLE_WORDS = frozenset("article entry post story recipe".split())
_ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert menu".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"
                    r"([^>\"']*+(?:\"[^\"]*+\"[^>\"']*+|'[^']*+'[^>\"']*+)*+)>"
                    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)  # the last: a quote is never closed
_ATTR = re.compile(r"(?<![\w-])(class|id|role|style)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_INSIDE = re.compile(r".*/(?:article|main)(?:\.[^/]*)?/", re.S)
_NUMBER = re.compile(r"[-_]*\d+$")
_PARTS = re.compile(r"[-_]+")
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_NOT_SHOWN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_HREF = re.compile(r"(?:^|\s)href\s*=", re.I)
_HEADING = re.compile(r"h[1-6](?:\.|$)")
_BOX = re.compile(r"(?:div|section)(?:\.|$)")


def _names_noise(word: str) -> bool:
    """Whether a class or id is a noise word, or starts or ends with one: ``ad``, ``main-nav``,
    ``reader-comments``; not ``has-sidebar`` (a wrapper) or ``entry-header`` (the title)."""
    word = _NUMBER.sub("", word)
    if word in _NOISE_WORDS:
        return True
    parts = [x for x in _PARTS.split(word) if x]
    if len(parts) < 2 or not _WRAPPER_WORDS.isdisjoint(parts):
        return False
    if parts[-1] in ("header", "banner") and not _TITLE_WORDS.isdisjoint(parts):
        return False
    return parts[0] in _NOISE_WORDS - {"header"} or parts[-1] in _NOISE_WORDS


def _label(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """(tag with its classes, whether its prior importance is 0, whether a class or id is a
    noise word, which an article inside outweighs)."""
    never, word = tag in _NEVER, False
    if not attrs.strip():
        return tag, never, word
    words: list[str] = []
    for name, *values in _ATTR.findall(attrs):
        value = next((v for v in values if v), "").lower()
        if name.lower() == "role":
            never = never or value.strip() in _ROLES
        elif name.lower() == "style":
            never = never or bool(_NOT_SHOWN.search(value))
        else:
            words += value.split()
    never = never or bool(_HIDDEN.search(_QUOTED.sub("", attrs)))
    if tag not in ("body", "html", "article", "main"):
        word = any(_names_noise(w) for w in words)
    # digits differ from page to page (post-17); the style is the same
    named = sorted({re.sub(r"\d+", "0", w) for w in words})
    return tag + "".join("." + w for w in named), never, word


def parse(page: str):
    """(blocks, styles): the text blocks in page order as (path, prior, text, linked), and each
    block element as (path, child labels).  prior: 0 noise, 1 open, 2 article; linked: more
    than half of the text is in links."""
    blocks: list[tuple[str, int, str, tuple, bool]] = []
    styles: list[tuple[str, list[str]]] = []
    # tag, path, prior, children, for each branch around that a noise word names whether it holds an article
    stack: list[tuple[str, str, int, list[str], tuple]] = [("", "", 1, [], ())]
    inline: list[str] = []  # the outermost open inline element with prior 0 and those inside it
    buffer: list[str] = []
    link, linked = False, [0]  # whether a link is open, its characters since the last block

    def flush():
        if buffer:
            raw = "".join(buffer)
            text = " ".join(html.unescape(raw).split())
            buffer.clear()
            if text:
                blocks.append((stack[-1][1], stack[-1][2], text, stack[-1][4],
                               2 * linked[0] > len("".join(raw.split()))))
        linked[0] = 0

    def put(text: str):
        buffer.append(text)
        if link:
            linked[0] += len("".join(text.split()))

    def close(depth: int):
        flush()
        while len(stack) > depth:
            _, path, _, children, _ = stack.pop()
            styles.append((path, children))

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            if not inline:
                put(page[at:])
            break
        if m.start() > at and not inline:
            put(page[at:m.start()])
        at = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        tag = (tag or "").lower()
        if not tag:
            continue
        if closing:  # an end tag closes the nearest open element of its name
            if tag in _INLINE:
                if tag == "a":
                    link = False
                if tag in inline:  # also closes what is open inside it
                    del inline[len(inline) - 1 - inline[::-1].index(tag):]
                continue
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                inline.clear()
                close(depth)
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in _INLINE or tag in _VOID:
            if tag in ("br", "hr", "img"):
                buffer.append(" ")
                if tag == "hr":
                    flush()
            elif tag not in _VOID:
                if tag == "a":
                    link = bool(_HREF.search(attrs))
                if inline or (attrs.strip() and _is_noise(tag, attrs, stack)):
                    inline.append(tag)
            continue
        inline.clear()
        if tag in _CLOSES_P:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p"), 0)
            if depth:
                close(depth)
        if tag in _SIBLINGS and stack[-1][0] in _SIBLINGS[tag]:
            close(len(stack) - 1)
        flush()
        label, never, word = _label(tag, attrs)
        path, prior, named = stack[-1][1] + "/" + label, stack[-1][2], stack[-1][4]
        inside = any(s[0] in ("article", "main") for s in stack)
        if never or (tag == "header" and not inside):
            prior = 0
        elif prior and tag in ("article", "main"):
            prior = 2
            for holds in named:
                holds[0] = True
        if word:
            named += ([False],)
        stack[-1][3].append(label)
        if not attrs.endswith("/"):
            stack.append((tag, path, prior, [], named))
    close(1)
    return [(p, prior if all(h[0] for h in named) else 0, t, a) for p, prior, t, named, a in blocks], styles


def _is_noise(tag: str, attrs: str, stack) -> bool:
    """Whether an inline element is noise; classes within ``pre`` name the parts of code."""
    _, never, word = _label(tag, attrs)
    return never or (word and not any(s[0] == "pre" for s in stack))


def host_of(url: str | None) -> str:
    at = (url or "").find("://")
    return re.split(r"[/?#]", url[at + 3:], maxsplit=1)[0].lower() if at >= 0 else ""


_STATS = "host string, path string, kind string, feature bigint, n bigint"


def _hash(text: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def copied_pages(pages: DataFrame) -> DataFrame:
    """h (hash of url and html), copies: the pages whose open blocks several pages of their
    host have."""
    def run(batches):
        for batch in batches:
            keys = []
            for url, page in zip(batch.column(1), batch.column(2)):
                blocks, _ = parse(page.as_py() or "")
                keys.append(_hash("\0".join([host_of(url.as_py()), *(x for p, prior, t, _ in blocks if prior for x in (p, t))])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64())], names=["h", "k"])

    found = materialize(pages.select(_page_hash().alias("h"), "url", "html").mapInArrow(run, "h bigint, k bigint"), "page-keys")
    copies = materialize(found.groupBy("k").agg(F.count("*").alias("copies")).filter("copies > 1"), "page-copies")
    # a written table: Spark broadcasts it when its size is small
    return materialize(found.join(copies, "k").groupBy("h").agg(F.max("copies").alias("copies")), "copied-pages")


def _page_hash():
    return F.xxhash64("url", "html")


def style_trees(pages: DataFrame) -> DataFrame:
    """host, path, kind (page, style or block), feature, n: the merged trees of all hosts."""
    def counted(counts: Counter):
        keys = list(zip(*counts)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(k, t) for k, t in zip(keys, (pa.string(), pa.string(), pa.string(), pa.int64()))),
             pa.array(list(counts.values()), pa.int64())], names=["host", "path", "kind", "feature", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for url, page, copies in zip(batch.column(0), batch.column(1), batch.column(2)):
                host = host_of(url.as_py())
                blocks, styles = parse(page.as_py() or "")
                seen = {(host, p, "block", _hash(t)) for p, prior, t, _ in blocks if prior}
                open_paths = {p for _, p, _, _ in seen}
                every = {a for p in open_paths for a in _ancestors(p)}
                seen |= {(host, p, "page", 0) for p in every}
                style: dict[str, list] = {}
                for p, children in styles:
                    if p in every:
                        style.setdefault(p, []).append(",".join(children))
                seen |= {(host, p, "style", _hash(";".join(s))) for p, s in style.items()}
                share = ONE // (copies.as_py() or 1)
                for key in seen:
                    counts[key] += share
                if len(counts) >= HELD:
                    yield counted(counts)
                    counts = Counter()
        if counts:
            yield counted(counts)

    rows = pages.withColumn("h", _page_hash()).join(copied_pages(pages), "h", "left")
    parts = rows.select("url", "html", "copies").mapInArrow(run, _STATS)
    # n distinct pages add up to n * ONE less a few units
    return parts.groupBy("host", "path", "kind", "feature").agg(
        F.greatest(F.round(F.sum("n") / ONE).cast("long"), F.lit(1)).alias("n"))


def _ancestors(path: str) -> list[str]:
    cuts = [i for i, c in enumerate(path) if c == "/"][1:] + [len(path)]
    return [path[:i] for i in cuts]


def noise_branches(trees: DataFrame) -> DataFrame:
    """host, branches (paths of low importance), known (paths with text outside articles, of
    high importance)."""
    trees = materialize(trees, "style-trees")
    pages = trees.filter("kind = 'page'").select("host", "path", F.col("n").alias("m")).filter(F.col("m") >= MIN_PAGES)
    # entropy sums per node; blocks count for the node and all branches above it
    # (combined before the shuffle; the page counts join one row a node)
    sums = trees.filter("kind <> 'page'").groupBy("host", "path", "kind").agg(
        F.sum(F.col("n") * F.log("n")).alias("nlogn"), F.sum("n").alias("w"))
    own = sums.filter("kind = 'block'").join(pages, ["host", "path"]).select(
        "host", "path", (F.col("nlogn") / F.log("m")).alias("h"), "w")
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    content = own.withColumn("path", F.explode(above)).groupBy("host", "path").agg(
        (1 - F.sum("h") / F.sum("w")).alias("content"))
    # -sum(n/m * ln(n/m)) / ln(m)
    styles = sums.filter("kind = 'style'").join(pages, ["host", "path"]).select(
        "host", "path", ((F.col("w") * F.log("m") - F.col("nlogn")) / (F.col("m") * F.log("m"))).alias("presentation"))
    importance = GAMMA * F.col("content") + (1 - GAMMA) * F.coalesce("presentation", F.lit(0.0))
    inside = F.col("path").rlike(r"(?s)/(article|main)(\.[^/]*)?(/|$)")
    score = content.join(pages, ["host", "path"]).join(styles, ["host", "path"], "left") \
        .join(own.select("host", "path", F.lit(True).alias("text")), ["host", "path"], "left").select(
            "host", "path", "text", inside.alias("inside"),
            F.when(inside, ARTICLE + (1 - ARTICLE) * importance).otherwise(importance).alias("importance"))
    low = F.col("importance") < THRESHOLD
    return score.groupBy("host").agg(
        F.sort_array(F.collect_set(F.when(low, F.col("path")))).alias("branches"),
        F.sort_array(F.collect_set(F.when(~low & F.col("text") & ~F.col("inside"), F.col("path")))).alias("known")) \
        .filter("size(branches) + size(known) > 0")


def main_text(page: str, branches, known=()) -> str:
    """The blocks outside noise branches.  On a page with an article, those beside it stay
    only if their path is ``known``, and those inside it without a second sign of noise."""
    blocks, _ = parse(page)
    noise, known = set(branches), set(known)
    article = any(prior == 2 for _, prior, _, _ in blocks)

    def noisy(path: str, prior: int) -> list[str]:
        # of an article's branches those inside it count
        start = m.end() if prior == 2 and (m := _INSIDE.match(path)) else 0
        judged = [a for a in _ancestors(path) if len(a) > start] if prior == 1 or start else []
        if judged and _HEADING.match(path.rsplit("/", 1)[1]):
            judged.pop()  # goes with the branch that it heads
        return [a for a in judged if a in noise]

    kept, tail = [], True
    for path, prior, text, linked in reversed(blocks):
        if not prior or (article and prior == 1 and path not in known):
            continue
        found = noisy(path, prior) if noise else []
        if prior == 2:
            if found and not linked and not (tail and any(_BOX.match(a.rsplit("/", 1)[1]) for a in found)):
                found = []
            tail = tail and bool(found)
        if not found:
            kept.append(text)
    kept.reverse()
    return "\n\n".join(kept or [t for _, prior, t, _ in blocks if prior == (2 if article else 1)])


def extract(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """<id>, url, text, n_chars per page."""
    kinds = dict(pages.dtypes)
    rows = pages.select(id_col, F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    noise = materialize(noise_branches(style_trees(rows)), "noise-branches")
    at = F.instr("url", "://")
    host = F.lower(F.regexp_extract(F.substr("url", at + 3), r"(?s)^([^/?#]*)", 1))
    keyed = rows.withColumn("host", F.coalesce(F.when(at > 0, host), F.lit("")))
    # a written table: Spark broadcasts it when its size is small, else joins by shuffle
    joined = keyed.join(noise, "host", "left").select(id_col, "url", "html", "branches", "known")

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py() or "", b.as_py() or (), k.as_py() or ())
                     for p, b, k in zip(batch.column(2), batch.column(3), batch.column(4))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[id_col, "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, url string, text string, n_chars bigint")


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages)
