"""URL filters: path rules first, then a host's reputation by empirical Bayes.

Labelled pages are counted as bad or good per host. A host's rate of bad pages is shrunk towards its registered
domain's, that towards its suffix's, that towards the rate of all pages, each through a beta-binomial prior whose
strength comes from how much the rates of that level differ (method of moments). A page is blocked if the lower
bound of its host's posterior lies above ``most_bad``. DataFrame functions only.

* Null url, or none with ``://``: host and path are empty; it meets no rule and is judged by the overall rate.
* Repeated pages count as often as they occur, unlabelled ones not at all. No label at all: everything is allowed
  that no rule blocks. A host that only the path rules know is judged by its domain's or suffix's labels.
* Columns beside ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``where`` is a host and, from its first slash, the start of a path."""

    where: str
    verdict: str

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        return self.where[len(self.host) :]


RULES = (
    Rule("net/", "block"),
    Rule("example.net/en/", "allow"),
    Rule("example.com/de/", "block"),
    Rule("org/fr/", "allow"),
)
#: Standard deviations between a posterior's mean and its bound, and the rate of bad pages that the bound must exceed.
Z, MOST_BAD = 1.645, 0.5
#: A prior weighs between about 1 and 1,000 pages.
LEAST_RHO, MOST_RHO = 0.001, 0.5


def with_place(pages: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path`` of ``url``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    found = pages.withColumn("_rest", rest).withColumn("_host", F.regexp_extract("_rest", r"\A[^/?#]*", 0))
    after = F.expr("substring(_rest, char_length(_host) + 1)")
    return found.select(
        *[F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path")],
        F.translate("_host", UPPER, LOWER).alias("host"),
        F.regexp_extract(after, r"\A[^?#]*", 0).alias("path"),
    )


def fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def longest(rules: tuple[Rule, ...], what: str) -> Column:
    """``what`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.where)):
        found = F.when(fits(rule), getattr(rule, what)).otherwise(found)
    return found


def domain() -> Column:
    return F.substring_index("host", ".", -2)


def suffix() -> Column:
    return F.substring_index("host", ".", -1)


def strength(level: DataFrame) -> DataFrame:
    """One row, the prior's weight in pages, from rates of bad pages (``bad`` of ``n``) around their ``prior``."""
    spread = "n * pow(bad / n - prior, 2) - prior * (1 - prior)"
    rho = F.expr(f"sum({spread}) / nullif(sum(prior * (1 - prior) * (n - 1)), 0)")
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(LEAST_RHO)), F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    return level.agg((1 / rho - 1).alias("k"))


def shrunk(counts: DataFrame, key: str) -> DataFrame:
    """Posterior (``a``, ``b``) and mean of each key's rate, from ``n``, ``bad`` and ``prior``."""
    k = strength(counts).scalar()
    held = counts.withColumn("_k", k)
    return held.select(
        key,
        F.expr("bad + _k * prior").alias("a"),
        F.expr("n - bad + _k * (1 - prior)").alias("b"),
        F.expr("(bad + _k * prior) / (n + _k)").alias("mean"),
    )


def reputation(labelled: DataFrame) -> dict[str, DataFrame]:
    """Posteriors by host, domain and suffix, and of all pages, from rows of ``host`` and ``bad`` (0 or 1)."""
    hosts = labelled.where("host <> ''").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = hosts.withColumn("domain", domain()).withColumn("suffix", suffix())
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    a, b = F.coalesce(F.sum("bad"), F.lit(0)) + 1, F.coalesce(F.sum(F.expr("n - bad")), F.lit(0)) + 1
    everything = suffixes.agg(a.cast("double").alias("a"), b.cast("double").alias("b"))
    overall = everything.select(F.expr("a / (a + b)")).scalar()
    by_suffix = shrunk(suffixes.withColumn("prior", overall), "suffix")
    prior = by_suffix.select("suffix", F.col("mean").alias("prior"))
    by_domain = shrunk(domains.join(prior, "suffix"), "domain")
    prior = by_domain.select("domain", F.col("mean").alias("prior"))
    by_host = shrunk(hosts.join(prior, "domain"), "host")
    return {"host": by_host, "domain": by_domain, "suffix": by_suffix, "all": everything}


def bound(a: Column, b: Column, z: float) -> Column:
    """Lower bound of a beta posterior: its mean less ``z`` standard deviations."""
    mean = a / (a + b)
    return mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))


def url_verdicts(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    z: float = Z,
    most_bad: float = MOST_BAD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_bound) of each row of ``pages`` (page_id, url).

    ``outcomes`` (page_id, bad) are the labelled pages, one row each; ``bad`` is 1 or 0, null rows are ignored.
    The levels' posteriors meet the distinct hosts first, so the pages are joined once, by host.
    """
    placed = with_place(pages.select("page_id", "url")).drop("url")
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    levels = reputation(placed.select("page_id", "host").join(known, "page_id").select("host", "bad"))
    hosts = placed.select("host").distinct().withColumn("domain", domain()).withColumn("suffix", suffix())
    for name in ("host", "domain", "suffix"):
        level = levels[name].select(name, F.col("a").alias(f"a_{name}"), F.col("b").alias(f"b_{name}"))
        hosts = hosts.join(level, name, "left")
    all_a, all_b = (levels["all"].select(c).scalar() for c in ("a", "b"))
    hosts = hosts.withColumn("_a", F.coalesce("a_host", "a_domain", "a_suffix", all_a))
    hosts = hosts.withColumn("_b", F.coalesce("b_host", "b_domain", "b_suffix", all_b))
    judged = placed.join(hosts.select("host", bound(F.col("_a"), F.col("_b"), z).alias("bad_bound")), "host", "left")
    own = F.when(F.col("bad_bound") > most_bad, "block").otherwise("allow")
    return judged.select(
        "page_id",
        "host",
        "path",
        longest(rules, "where").alias("rule"),
        F.coalesce(longest(rules, "verdict"), own).alias("verdict"),
        "bad_bound",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every page; a page labelled as low quality (``labels``, by the page's number) is a bad outcome."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).cast("long").alias("bad")
    )
    return url_verdicts(table(spark, sf_dir, "pages"), outcomes).drop("bad_bound")


def _k(level: str) -> str:
    spread = "n * pow(bad / n - prior, 2) - prior * (1 - prior)"
    rho = f"sum({spread}) / nullif(sum(prior * (1 - prior) * (n - 1)), 0)"
    return f"(SELECT 1 / least(greatest(coalesce({rho}, {LEAST_RHO}), {LEAST_RHO}), {MOST_RHO}) - 1 FROM {level})"


def _fits(r: Rule) -> str:
    return f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"


_ORDER = sorted(RULES, key=lambda r: -len(r.where))
_RULE = "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{r.where}'" for r in _ORDER) + " END"
_VERDICT = "CASE " + " ".join(f"WHEN {_fits(r)} THEN '{r.verdict}'" for r in _ORDER)
SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut2 AS (
  SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '\\A[^/?#]*') AS h FROM cut
), placed AS (
  SELECT page_id, translate(h, '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(h) + 1), '\\A[^?#]*') AS path FROM cut2
), named AS (
  SELECT DISTINCT host, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         string_split(host, '.')[-1] AS suffix FROM placed
), outcome AS (
  SELECT doc_id, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1
), hosts AS (
  SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(*) AS n, sum(bad) AS bad
  FROM placed JOIN outcome ON page_id = doc_id JOIN named USING (host) WHERE host <> '' GROUP BY 1
), domains AS (SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY 1),
everything AS (SELECT coalesce(sum(bad), 0) + 1.0 AS a, coalesce(sum(n - bad), 0) + 1.0 AS b FROM suffixes),
s1 AS (SELECT suffix, n, bad, (SELECT a / (a + b) FROM everything) AS prior FROM suffixes),
s2 AS (SELECT *, {_k("s1")} AS k FROM s1),
d1 AS (SELECT d.domain, d.n, d.bad, (s2.bad + k * prior) / (s2.n + k) AS prior FROM domains d JOIN s2 USING (suffix)),
d2 AS (SELECT *, {_k("d1")} AS k FROM d1),
h1 AS (SELECT h.host, h.n, h.bad, (d2.bad + k * prior) / (d2.n + k) AS prior FROM hosts h JOIN d2 USING (domain)),
h2 AS (SELECT *, {_k("h1")} AS k FROM h1),
post AS (
  SELECT named.host,
    coalesce(h2.bad + h2.k * h2.prior, d2.bad + d2.k * d2.prior, s2.bad + s2.k * s2.prior, e.a) AS a,
    coalesce(h2.n - h2.bad + h2.k * (1 - h2.prior), d2.n - d2.bad + d2.k * (1 - d2.prior),
             s2.n - s2.bad + s2.k * (1 - s2.prior), e.b) AS b
  FROM named LEFT JOIN h2 USING (host) LEFT JOIN d2 USING (domain) LEFT JOIN s2 USING (suffix), everything e
), bounds AS (
  SELECT host, a / (a + b) - {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS bad_bound FROM post
)
SELECT page_id, host, path, {_RULE} AS rule,
       {_VERDICT} WHEN bad_bound > {MOST_BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM placed LEFT JOIN bounds USING (host)
"""
