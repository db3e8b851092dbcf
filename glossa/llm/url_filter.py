"""URL filter: allow/block rules first, then empirical-Bayes host reputation.

*Rules* are (host, path prefix) pairs.  A rule fits its host and all subdomains, when
the url's path starts with the rule's path.  The longest fitting rule wins (host and
path characters together; equal lengths: the first in the list).

*Reputation* judges all other urls.  Labelled page outcomes (``bad`` = 0/1) are counted
per host, registered domain (last two labels) and suffix (last label).  Each level is a
beta-binomial whose prior mean is the posterior mean of the level above:
suffix <- all pages, domain <- suffix, host <- domain.  The prior strength of a level
is fitted by moments: the spread of the children's rates around their common mean,
beyond what binomial noise explains.  A url is blocked when even the lower posterior
bound (mean - z * standard deviation) of its host's bad rate exceeds ``max_bad``.

Only labels are aggregated (map-side, so a hot host costs one row per task); the tables
per host are joined back by host, where AQE splits a hot host.

Defined results: a url that is null or has no ``://`` has an empty host and path, fits
no rule and takes the rate of all pages; hosts never labelled take their domain's, else
their suffix's, else the overall posterior; without any label the bound is 0 and the url
is allowed; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: (verdict, host, path prefix)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
MAX_BAD = 0.5
Z = 1.645
#: Prior strength bounds and the strength of the prior of the topmost level.
LEAST, MOST, TOP = 1.0, 1000.0, 2.0


def host_of(url: Column) -> Column:
    """A-Z lower-cased text after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, low).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, rule verdict) of the longest fitting rule, else nulls.  The rules are
    a short configuration list; they become one CASE expression."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))
    name = verdict = None
    for i in order:
        v, h, p = rules[i]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def _level(rows: DataFrame, child: str, prior: DataFrame, on: str) -> DataFrame:
    """Posterior (a, b) per child.  ``rows``: child, on, n, bad.  ``prior``: on, m."""
    j = rows.join(prior, on)
    # moments: sum of squared excess over binomial noise, over all children with >= 2 labels
    rate = F.col("bad") / F.col("n")
    noise = F.col("m") * (1 - F.col("m"))
    many = F.col("n") >= 2
    # rounded to whole 1e-9 parts, so the sum does not depend on the order of the rows
    spread = j.agg(
        (F.sum(F.when(many, F.round((rate - F.col("m")) * (rate - F.col("m")) * 1e9).cast("long")))).alias("ss"),
        (F.sum(F.when(many, F.round(noise * 1e9).cast("long")))).alias("nn"),
        (F.sum(F.when(many, F.round(noise / F.col("n") * 1e9).cast("long")))).alias("nb"))
    # var = noise/n + (noise - noise/n) * rho   ->   strength = 1/rho - 1
    rho = (F.col("ss") - F.col("nb")) / (F.col("nn") - F.col("nb"))
    strength = (F.when(F.col("nn").isNull() | (F.col("nn") <= F.col("nb")), F.lit(TOP))
                 .when(rho <= 1 / (MOST + 1), F.lit(MOST))
                 .otherwise(F.greatest(F.lit(LEAST), 1 / rho - 1)))
    j = j.join(F.broadcast(spread.select(strength.alias("k"))))  # one row
    return j.select(child, F.round(F.col("k") * F.col("m") + F.col("bad"), 9).alias("a"),
                    F.round(F.col("k") * (1 - F.col("m")) + F.col("n") - F.col("bad"), 9).alias("b"))


def _mean(level: DataFrame, key: str) -> DataFrame:
    return level.select(key, F.round(F.col("a") / (F.col("a") + F.col("b")), 9).alias("m"))


def fit_reputation(outcomes: DataFrame) -> dict[str, DataFrame]:
    """Tables of beta posteriors from (host, bad): ``top`` (one row), ``suffix``,
    ``domain`` and ``host``, each (key, a, b)."""
    per_host = materialize(
        outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .select("host", domain_of(F.col("host")).alias("domain"),
                suffix_of(F.col("host")).alias("suffix"), "n", "bad"), "host-outcomes")
    tally = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    per_domain = per_host.groupBy("domain", "suffix").agg(*tally)
    per_suffix = per_host.groupBy("suffix").agg(*tally)
    top = per_host.agg(*[F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(tally, ("n", "bad"))]) \
        .select((F.lit(TOP / 2) + F.col("bad")).alias("a"),
                (F.lit(TOP / 2) + F.col("n") - F.col("bad")).alias("b"), "n")
    whole = top.select(F.round(F.col("a") / (F.col("a") + F.col("b")), 9).alias("m"))
    everything = F.broadcast(whole.withColumn("one", F.lit(1)))  # one row
    suffix = materialize(_level(per_suffix.withColumn("one", F.lit(1)), "suffix", everything,
                                "one"), "suffix-posterior")
    domain = materialize(_level(per_domain, "domain", _mean(suffix, "suffix"), "suffix"), "domain-posterior")
    host = materialize(_level(per_host, "host", _mean(domain, "domain"), "domain"), "host-posterior")
    return {"top": top, "suffix": suffix, "domain": domain, "host": host}


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    """Mean minus ``z`` standard deviations of Beta(a, b), at least 0."""
    s = a + b
    low = a / s - z * F.sqrt(a * b / (s * s * (s + 1)))
    return F.greatest(F.lit(0.0), F.round(low, 6))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD,
                z: float = Z, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """<id>, host, path, rule, verdict, bad_bound per page.  ``outcomes``: host, bad."""
    fit = fit_reputation(outcomes)
    p = pages.select(pages[id_col].alias("__id"), host_of(pages[url_col]).alias("host"),
                     path_of(pages[url_col]).alias("path"))
    p = p.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "ruled": ruled, "__domain": domain_of(F.col("host")),
                       "__suffix": suffix_of(F.col("host"))})

    def named(level, key, to, tag):
        return fit[level].select(F.col(key).alias(to), F.col("a").alias(f"a_{tag}"), F.col("b").alias(f"b_{tag}"))

    # hosts without labels fall back a level: their posterior is the parent's
    p = p.join(named("host", "host", "host", "h"), "host", "left")
    p = p.join(named("domain", "domain", "__domain", "d"), "__domain", "left")
    p = p.join(named("suffix", "suffix", "__suffix", "s"), "__suffix", "left")
    p = p.join(F.broadcast(fit["top"].select(F.col("a").alias("a_t"), F.col("b").alias("b_t"),
                                             F.col("n").alias("n_t"))))  # one row
    a, b = F.coalesce("a_h", "a_d", "a_s", "a_t"), F.coalesce("b_h", "b_d", "b_s", "b_t")
    bound = F.when(F.col("n_t") == 0, F.lit(0.0)).otherwise(lower_bound(a, b, z))
    p = p.withColumn("bad_bound", bound)
    judged = F.coalesce("ruled", F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow"))
    return p.select(F.col("__id").alias(id_col), "host", "path", "rule",
                    judged.alias("verdict"), "bad_bound")


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of the pages whose source document is labelled.  A page's url names its
    document: the digits that start the second path segment.  Bad: toxic, or of quality 0."""
    key = F.regexp_extract(path_of(F.col("url")), r"^/[^/]*/([0-9]{1,18})", 1)
    named = pages.select(host_of(F.col("url")).alias("host"), F.when(key != "", key.cast("long")).alias("doc_id"))
    bad = ((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).cast("int")
    return named.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("host", "bad")


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's verdict: by rule, else by its host's reputation."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_urls(pages, labelled_outcomes(pages, labels))


def _oracle_rules() -> str:
    order = sorted(range(len(RULES)), key=lambda i: (-len(RULES[i][1] + RULES[i][2]), i))
    fits = "(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    return "\n".join(f"       when {fits.format(h=RULES[i][1], p=RULES[i][2])} then '{RULES[i][0]} {RULES[i][1]}{RULES[i][2]}'"
                     for i in order)


def _oracle_level(child: str, table: str, on: str) -> str:
    """One beta-binomial level in SQL; ``table`` has child, n, bad, m."""
    return f"""
{child}_k as (
  select case when nn is null or nn <= nb then {TOP}
              when (ss - nb) / (nn - nb) <= {1 / (MOST + 1)!r} then {MOST}
              else greatest({LEAST}, 1 / ((ss - nb) / (nn - nb)) - 1) end as k
  from (select sum(cast(trunc(round((bad / n - m) * (bad / n - m) * 1e9)) as bigint)) filter (n >= 2) :: double as ss,
               sum(cast(trunc(round(m * (1 - m) * 1e9)) as bigint)) filter (n >= 2) :: double as nn,
               sum(cast(trunc(round(m * (1 - m) / n * 1e9)) as bigint)) filter (n >= 2) :: double as nb
        from ({table}))
), {child}_post as (
  select {child}, round(k * m + bad, 9) as a, round(k * (1 - m) + n - bad, 9) as b,
         round(round(k * m + bad, 9) / (round(k * m + bad, 9) + round(k * (1 - m) + n - bad, 9)), 9) as pm
  from ({table}), {child}_k
)"""


ORACLE_SQL = f"""
with u as (
  select page_id, coalesce(case when strpos(url, '://') > 0
                then regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1) end, '') as raw,
         coalesce(case when strpos(url, '://') > 0
                then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) end, '') as path
  from pages
), p as (
  select page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from u
), q as (
  select *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain,
         string_split(host, '.')[-1] as suffix,
         case
{_oracle_rules()} end as hit,
         try_cast(nullif(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1), '') as bigint) as doc_id
  from p
), o as (
  select q.host, any_value(domain) as domain, any_value(suffix) as suffix, count(*)::double as n,
         sum(case when coalesce(toxic, 0) = 1 or coalesce(quality, 1) = 0 then 1 else 0 end)::double as bad
  from q join labels l on l.doc_id = q.doc_id group by q.host
), top as (
  select {TOP / 2} + coalesce(sum(bad), 0) as a, {TOP / 2} + coalesce(sum(n - bad), 0) as b, coalesce(sum(n), 0) as n from o
),{_oracle_level('suffix', "select x.*, (select round(a / (a + b), 9) from top) as m from (select suffix, sum(n) as n, sum(bad) as bad from o group by suffix) x", '')},
{_oracle_level('domain', "select x.*, s.pm as m from (select domain, suffix, sum(n) as n, sum(bad) as bad from o group by domain, suffix) x join suffix_post s using (suffix)", 'suffix')},
{_oracle_level('host', "select x.*, d.pm as m from o x join domain_post d using (domain)", 'domain')},
r as (
  select q.*, case when t.n = 0 then 0.0 else greatest(0.0, round(
           v.a / (v.a + v.b) - {Z} * sqrt(v.a * v.b / ((v.a + v.b) * (v.a + v.b) * (v.a + v.b + 1))), 6)) end as bad_bound
  from (select q.*, coalesce(h.a, d.a, s.a, t.a) as a, coalesce(h.b, d.b, s.b, t.b) as b, t.n
        from q left join host_post h on h.host = q.host left join domain_post d on d.domain = q.domain
               left join suffix_post s on s.suffix = q.suffix, top t) v
  join q on q.page_id = v.page_id, top t
)
select page_id, host, path, split_part(hit, ' ', 2) as rule,
       coalesce(split_part(hit, ' ', 1), case when bad_bound > {MAX_BAD} then 'block' else 'allow' end) as verdict,
       bad_bound
from r
"""
