"""URL verdicts: listed rules first, then the empirical-Bayes reputation of the host.

Outcomes of labelled pages are summed by host, registered domain and suffix. Each level is
beta-binomial around the shrunk rate of the level above it; how strongly it is pulled there is
estimated from the spread of its own counts. A host is blocked if the lower posterior bound of its
rate of bad pages exceeds a limit. All steps are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recontact.llm.common import looked_up
from recontact.sources.storage import written_once

#: Host, path and verdict of each rule. A rule fits its host and all subdomains.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# Suffixes of two labels below which names belong to different owners.
SUFFIXES = (
    "ac.uk", "blogspot.com", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn",
    "com.mx", "com.tr", "com.tw", "example.com", "example.net", "example.org", "github.io", "gov.uk", "ne.jp", "net.au",
    "or.jp", "org.au", "org.uk",
)
#: A host is blocked if its rate of bad pages lies above ``LIMIT`` with 95 % of the posterior.
LIMIT, Z = 0.3, 1.645
#: Least and most pages that a level's prior counts for.
WEAKEST, STRONGEST = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The document that a page shows is named by the first number in its path, after a language.
DOC_IN_PATH = r"^/[a-z]+/([0-9]{1,18})(?:[^0-9]|\z)"


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` (A-Z in lower case) and ``path``, empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    cut = pages.withColumn("_rest", rest)
    host = F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return cut.withColumns({"host": host, "path": path}).drop("_rest")


def rule_of(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Rule and its verdict for columns ``host`` and ``path``, null where none fits. The longest rule
    wins, of equal ones the first in byte order. For lists of a few hundred rules."""
    rule = verdict = F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-b for b in (r[0] + r[1]).encode()])):
        own = F.col("host") == host
        fits = (own | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def with_levels(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """``hosts`` with ``domain`` and ``suffix`` of ``host``.

    User, port and a closing dot do not count. The suffix is the last label, or the last two if
    listed; the domain has one label more, where there is one. Numeric addresses are a domain of
    their own, below the empty suffix.
    """
    name = F.regexp_replace(F.regexp_replace("host", r"(?s)^.*@", ""), r"(:[0-9]*)?[.]*\z", "")
    two = F.regexp_extract("_name", r"[^.]*[.][^.]*\z", 0)
    numeric = F.col("_name").rlike(r"^[0-9.]*\z") | F.col("_name").startswith("[")
    listed = two.isin(*suffixes)
    suffix = F.when(numeric, "").when(listed, two).otherwise(F.regexp_extract("_name", r"[^.]*\z", 0))
    domain = (
        F.when(numeric, F.col("_name"))
        .when(listed, F.regexp_extract("_name", r"([^.]*[.])?[^.]*[.][^.]*\z", 0))
        .otherwise(F.regexp_extract("_name", r"([^.]*[.])?[^.]*\z", 0))
    )
    return hosts.withColumn("_name", name).withColumns({"domain": domain, "suffix": suffix}).drop("_name")


def labelled_hosts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host``, ``n_pages``, ``n_labelled`` and ``n_bad`` of all pages.

    A page has the label of the document that its path names: bad if one of its rows says quality 0 or
    toxic 1. Pages are summed by host and document before they meet the labels, so neither a hot
    host nor a hot document is a hot key.
    """
    doc = F.regexp_extract("path", DOC_IN_PATH, 1)
    named = pages.select("host", F.when(doc != "", doc).cast("long").alias("doc"))
    summed = named.groupBy("host", "doc").agg(F.count(F.lit(1)).alias("n"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    told = labels.filter("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    told = told.groupBy(F.col("doc_id").alias("doc")).agg(F.max(bad.cast("int")).alias("bad"))
    # Pages without a document need no label; they spread by a number of their own below zero.
    key = F.coalesce("doc", -1 - F.pmod(F.xxhash64("host"), F.lit(1 << 20)))
    met = summed.withColumn("doc", key).join(told.filter("doc >= 0"), "doc", "left")
    return met.groupBy("host").agg(
        F.sum("n").alias("n_pages"),
        F.sum(F.when(F.col("bad").isNotNull(), F.col("n")).otherwise(0)).alias("n_labelled"),
        F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("n_bad"),
    )


def strength(level: DataFrame) -> DataFrame:
    """One row ``k``: for how many pages the prior of a level counts.

    For rates spread as Beta(k m, k (1 - m)) around ``prior``, the squared deviation of a count beyond
    its binomial part is ``n (n - 1) m (1 - m) / (k + 1)`` on average.
    """
    n, m = F.col("n_labelled").cast("double"), F.col("prior")
    binomial = n * m * (1 - m)
    more = F.sum(F.pow(F.col("n_bad") - n * m, F.lit(2.0)) - binomial)
    share = more / F.nullif(F.sum(binomial * (n - 1)), F.lit(0.0))
    k = F.when(share > 0, F.lit(1.0) / share - 1)
    return level.agg(F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), F.coalesce(k, F.lit(STRONGEST)))).alias("k"))


def reputation(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES, z: float = Z) -> DataFrame:
    """``hosts`` with ``rate``, the posterior mean of a host's rate of bad pages, and ``bound``, that
    mean less ``z`` posterior deviations.

    Suffixes are shrunk to the rate of all pages, domains to their suffix and hosts to their domain.
    A host without labels has its domain's rate and a wide posterior. Without any label the rate of
    all is one half.
    """
    own = written_once(with_levels(hosts, suffixes), "hosts")
    sums = [F.sum("n_labelled").alias("n_labelled"), F.sum("n_bad").alias("n_bad")]
    domains = written_once(own.groupBy("domain", "suffix").agg(*sums, F.count(F.lit(1)).alias("below")), "domains")
    suffix = domains.groupBy("suffix").agg(*sums, F.count(F.lit(1)).alias("below"))
    overall = hosts.agg(
        ((F.coalesce(F.sum("n_bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n_labelled"), F.lit(0)) + 1.0)).alias("m")
    )
    suffix = written_once(suffix.withColumn("prior", overall.scalar()), "suffixes")
    rates = _shrunk(suffix).select("suffix", F.col("rate").alias("prior"), "below")
    domains = written_once(looked_up(domains, rates, ["suffix"], "below", spread="domain"), "domains")
    rates = _shrunk(domains).select("domain", F.col("rate").alias("prior"), "below")
    own = written_once(looked_up(own, rates, ["domain"], "below", spread="host"), "hosts")
    told = _shrunk(own)
    size = F.col("n_labelled") + F.col("k")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
    return told.withColumn("bound", F.col("rate") - z * deviation).drop("prior", "k")


def _shrunk(level: DataFrame) -> DataFrame:
    with_k = level.withColumn("k", strength(level).scalar())
    return with_k.withColumn(
        "rate", (F.col("n_bad") + F.col("k") * F.col("prior")) / (F.col("n_labelled") + F.col("k"))
    )


def judged(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT
) -> DataFrame:
    """One row for each page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, the labelled and
    bad pages of its host and ``bound``, rounded to six places.

    The verdict is that of the longest rule that fits, else ``block`` if the host's bound exceeds
    ``limit`` and ``allow`` otherwise. A null address, one without ``://`` and one without a host have the
    empty host, which is judged like others. Repeated rows are judged alike and each returned and
    counted; ids may be null. Empty tables give no rows. Only ``page_id`` and ``url`` are read, and
    ``doc_id``, ``quality`` and ``toxic`` of the labels; labels without a document tell nothing.
    """
    cut = with_host_and_path(pages.select("page_id", "url")).drop("url")
    hosts = written_once(labelled_hosts(cut, labels), "labelled")
    known = reputation(hosts).select("host", "n_pages", "n_labelled", "n_bad", "bound")
    rows = looked_up(cut, known, ["host"], "n_pages", spread="page_id")
    rule, says = rule_of(rules)
    method = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, method).alias("verdict"),
        "n_labelled", "n_bad", F.round("bound", 6).alias("bound"),
    )


def judged_sql(rules: Sequence[tuple[str, str, str]] = RULES, limit: float = LIMIT) -> str:
    """The same rows in DuckDB."""
    fit = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    order = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    cases = [" ".join(f"WHEN {fit.format(h, p)} THEN '{x}'" for h, p, x in each) for each in (
        [(h, p, h + p) for h, p, _ in order], order)]
    listed = ", ".join(f"'{s}'" for s in SUFFIXES)

    def shrunk(level: str) -> str:
        return f"""
{level}_k AS (SELECT greatest({WEAKEST}::DOUBLE, least({STRONGEST}::DOUBLE,
    coalesce(CASE WHEN more / part > 0 THEN 1 / (more / part) - 1 END, {STRONGEST}::DOUBLE))) AS k
  FROM (SELECT sum(pow(n_bad - n_labelled * prior, 2) - n_labelled * prior * (1 - prior)) AS more,
      nullif(sum(n_labelled * prior * (1 - prior) * (n_labelled - 1)), 0) AS part FROM {level})),
{level}_rate AS (SELECT *, (n_bad + k * prior) / (n_labelled + k) AS rate FROM {level}, {level}_k)"""

    return f"""
WITH cut AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
told AS (SELECT doc_id, max((coalesce(quality = 0, false) OR coalesce(toxic = 1, false))::INT) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
hosts AS (SELECT host, count(bad)::DOUBLE AS n_labelled, coalesce(sum(bad), 0)::DOUBLE AS n_bad FROM cut
  LEFT JOIN told ON doc_id = nullif(regexp_extract(path, '{DOC_IN_PATH}', 1), '')::BIGINT GROUP BY host),
named AS (SELECT *, regexp_replace(regexp_replace(host, '(?s)^.*@', ''), '(:[0-9]*)?[.]*\\z', '') AS name FROM hosts),
leveled AS (SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]*\\z') OR starts_with(name, '[') THEN ''
    WHEN regexp_extract(name, '[^.]*[.][^.]*\\z') IN ({listed}) THEN regexp_extract(name, '[^.]*[.][^.]*\\z')
    ELSE regexp_extract(name, '[^.]*\\z') END AS suffix,
    CASE WHEN regexp_matches(name, '^[0-9.]*\\z') OR starts_with(name, '[') THEN name
    WHEN regexp_extract(name, '[^.]*[.][^.]*\\z') IN ({listed}) THEN regexp_extract(name, '([^.]*[.])?[^.]*[.][^.]*\\z')
    ELSE regexp_extract(name, '([^.]*[.])?[^.]*\\z') END AS domain FROM named),
suffixes AS (SELECT suffix, sum(n_labelled) AS n_labelled, sum(n_bad) AS n_bad,
    (SELECT (sum(n_bad) + 0.5::DOUBLE) / (sum(n_labelled) + 1) FROM hosts) AS prior FROM leveled GROUP BY suffix),{shrunk("suffixes")},
domains AS (SELECT domain, suffix, sum(l.n_labelled) AS n_labelled, sum(l.n_bad) AS n_bad, any_value(rate) AS prior
  FROM leveled l JOIN suffixes_rate USING (suffix) GROUP BY domain, suffix),{shrunk("domains")},
own AS (SELECT host, l.n_labelled, l.n_bad, rate AS prior FROM leveled l JOIN domains_rate USING (domain, suffix)),{shrunk("own")},
known AS (SELECT *, rate - {Z}::DOUBLE * sqrt(rate * (1 - rate) / (n_labelled + k + 1)) AS bound FROM own_rate)
SELECT page_id, host, path, CASE {cases[0]} END AS rule,
  coalesce(CASE {cases[1]} END, CASE WHEN bound > {limit}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
  n_labelled::BIGINT AS n_labelled, n_bad::BIGINT AS n_bad, round(bound, 6) AS bound
FROM cut JOIN known USING (host)"""
