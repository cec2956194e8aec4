"""Empirical-Bayes reputation of hosts.

Bad outcomes of labelled pages are counted by host, registered domain and public
suffix.  Each level's rates are shrunk towards the level above: a beta prior has
the parent's posterior mean and a strength fitted by the method of moments over
all units of the level.  A page goes if the lower quantile of its host's beta
posterior lies above the limit.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import saved, table

#: Public suffixes of two labels that are known where a caller gives no rules, beside generic labels under a country; all others have one label.
SUFFIXES = "co.uk org.uk ac.uk gov.uk com.au net.au org.au co.jp ne.jp or.jp co.nz com.br com.cn com.mx co.in co.kr co.za com.ar com.tr github.io blogspot.com".split()
_TWO = "(" + "|".join(s.replace(".", "[.]") for s in SUFFIXES) + ")$"
_GENERIC = "^(com|co|net|org|edu|gov|ac)[.][a-z]{2}$"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[\]]+)"
#: An address in numbers, which is no name under any suffix.
_NUMERIC = r"^([0-9]+([.][0-9]+){3}|\[.*\])$"
STRENGTH_LEAST, STRENGTH_MOST = 0.5, 1000.0
#: A page goes if the share of bad pages of its host is above LIMIT with as much certainty as a normal variable is above -Z.
LIMIT, Z = 0.3, 1.0


def host_of(url: Column) -> Column:
    """The host of an absolute URL in lower case, without a trailing dot or a leading ``www.``; empty if there is none."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), r"^www[.]|[.]$", "")


def suffix_of(host: Column) -> Column:
    """The public suffix by the built-in rules; an address in numbers is its own."""
    two = F.regexp_extract(host, r"(^|[.])([^.]+[.][^.]+)$", 2)
    named = F.when(two.rlike("^" + _TWO) | two.rlike(_GENERIC), two).otherwise(F.regexp_extract(host, r"([^.]*)$", 1))
    return F.when(host.rlike(_NUMERIC), host).otherwise(named)


def domain_of(host: Column, suffix: Column) -> Column:
    """The label before the suffix, and the suffix; the host itself where nothing stands before."""
    rest = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(F.length(host) <= F.length(suffix), host).otherwise(F.concat(F.regexp_extract(rest, r"([^.]*)$", 1), F.lit("."), suffix))


def with_suffixes(hosts: DataFrame, rules: Iterable[str]) -> DataFrame:
    """``hosts(host)``, distinct, with ``suffix`` by the rules of a public suffix list.

    A rule is a suffix, ``*.`` and a suffix for any label before it, or ``!`` and a name
    that such a rule doesn't hold for.  The longest rule wins; without any the last
    label is the suffix.  The list is of a fixed size and is broadcast.
    """
    kinds = {}
    for rule in (r.strip().lower() for r in rules):
        if rule and not rule.startswith("//"):
            name = rule.removeprefix("!").removeprefix("*.")
            one = kinds.setdefault(name, [False, False, False])
            one[2 if rule[0] == "!" else 1 if rule.startswith("*.") else 0] = True
    table_ = hosts.sparkSession.createDataFrame([(n, *k) for n, k in kinds.items()], "tail string, plain boolean, below boolean, never boolean")
    labels = F.split("host", "[.]")
    tails = hosts.select("host", F.size(labels).alias("labels"), F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(labels, -n, n), ".").alias("tail")))).alias("t")).select("host", "labels", "t.*")
    size = F.when(F.col("never"), 1000 + F.col("n") - 1).when(F.col("below") & (F.col("labels") > F.col("n")), F.col("n") + 1).when(F.col("plain"), F.col("n"))
    best = tails.join(F.broadcast(table_), "tail", "left").groupBy("host").agg((F.coalesce(F.max(size), F.lit(1)) % 1000).alias("n"))
    suffix = F.array_join(F.slice(labels, -F.col("n"), F.col("n")), ".")
    return best.select("host", F.when(F.col("host").rlike(_NUMERIC) | (F.col("host") == ""), F.col("host")).otherwise(suffix).alias("suffix"))


def _strength(units: DataFrame) -> float:
    """The prior's strength k, from how far rates scatter about their means beyond binomial noise."""
    q = F.col("m") * (1 - F.col("m"))
    rate = F.col("bad") / F.col("n")
    # E[n (rate - m)^2] = q (1 + (n - 1) rho), rho = 1 / (k + 1)
    over = F.sum(F.round(F.col("n") * (rate - F.col("m")) * (rate - F.col("m")) - q, 9).cast("decimal(38,9)")).cast("double")
    scale = F.sum(F.round((F.col("n") - 1) * q, 9).cast("decimal(38,9)")).cast("double")
    rho = F.when(scale > 0, over / scale).otherwise(F.lit(0.0))
    k = F.when(rho <= 1 / (STRENGTH_MOST + 1), F.lit(STRENGTH_MOST)).otherwise(F.greatest(F.lit(STRENGTH_LEAST), 1 / rho - 1))
    return units.where("n > 0").agg(F.round(k, 6).alias("k")).first()["k"]


def lower_quantile(rate: Column, s: Column, z: float) -> Column:
    """The quantile of a beta posterior, of mean ``rate`` and ``s`` observations with the prior's, that a normal variable has at -z.

    By the Cornish-Fisher expansion with skewness and kurtosis.
    """
    a, b = rate * s, (1 - rate) * s
    spread = F.sqrt(rate * (1 - rate) / (s + 1))
    skew = 2 * (b - a) * F.sqrt(s + 1) / ((s + 2) * F.sqrt(a * b))
    excess = 6 * ((a - b) * (a - b) * (s + 1) - a * b * (s + 2)) / (a * b * (s + 2) * (s + 3))
    at = -z + (z * z - 1) * skew / 6 + (3 * z - z**3) * excess / 24 - (5 * z - 2 * z**3) * skew * skew / 36
    return F.round(F.greatest(F.lit(0.0), rate + spread * at), 6)


def reputations(pages: DataFrame, labels: DataFrame, url_col: str = "url", id_col: str = "page_id", label_id: str = "doc_id", label: str = "quality", limit: float = LIMIT, z: float = Z, rules: Iterable[str] | None = None) -> DataFrame:
    """``(page_id, host, domain, suffix, n, bad, rate, lower, keep)``, one row per row of ``pages``.

    A labelled page is bad if its label is 0; labels that are null or of no page
    count for nothing, a page with several labels counts by each.  Hosts without
    labelled pages take their domain's posterior, and so on up.  A null or
    malformed URL has the empty host, domain and suffix, which are a unit like any
    other; an address in numbers is its own domain and suffix.  ``rules`` are those of
    a public suffix list, a few built-in ones otherwise.  ``lower`` is the posterior's
    lower quantile; a page is kept unless it exceeds ``limit``.  Repeated rows of pages
    have a row each, columns of other names aren't read, very long URLs are taken whole.
    Empty tables give no rows, or prior means.
    """
    p = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"))
    y = labels.where(F.col(label_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(label_id).alias("page_id")).agg(F.count("*").alias("n"), F.sum((F.col(label) == 0).cast("long")).alias("bad"))
    # A row a host; all levels above, and every prior, come from it, so it is written once, as each level is.
    hosts = saved(p.join(y, "page_id", "left").groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host"))) if rules is None else hosts.join(with_suffixes(hosts.select("host"), rules), "host")
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    domains = saved(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = saved(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    whole = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m")).first()["m"]

    def shrunk(joined: DataFrame) -> DataFrame:
        joined = saved(joined)
        k = _strength(joined)
        k = STRENGTH_MOST if k is None else k
        return joined.withColumn("s", F.lit(k) + F.col("n")).withColumn("rate", F.round((F.col("m") * k + F.col("bad")) / F.col("s"), 9))

    s = shrunk(suffixes.withColumn("m", F.lit(whole)))
    d = shrunk(domains.join(s.select("suffix", F.col("rate").alias("m")), "suffix"))
    h = shrunk(hosts.join(d.select("domain", "suffix", F.col("rate").alias("m")), ["domain", "suffix"]))
    h = h.withColumn("lower", lower_quantile(F.col("rate"), F.col("s"), z))
    h = h.select("host", "domain", "suffix", "n", "bad", F.round("rate", 6).alias("rate"), "lower", (F.col("lower") <= limit).alias("keep"))
    return p.join(h, "host").select("page_id", "host", "domain", "suffix", "n", "bad", "rate", "lower", "keep")


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reputation of every page, by the labels of quality whose ``doc_id`` is its ``page_id``; edge cases as in ``reputations``.

    The test tables label documents, so that outcome is a stand-in for one of pages.
    """
    return reputations(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def _level(name: str, units: str, keys: str, above: str) -> str:
    join = f"JOIN {above} USING ({keys})" if keys else f"CROSS JOIN {above}"
    return f"""
{name}_m AS (SELECT * FROM {units} {join}),
{name}_k AS (
    SELECT round(CASE WHEN rho <= 1 / ({STRENGTH_MOST} + 1) THEN {STRENGTH_MOST} ELSE greatest({STRENGTH_LEAST}, 1 / rho - 1) END, 6) AS k
    FROM (SELECT CASE WHEN v > 0 THEN o / v ELSE 0 END AS rho FROM (
        SELECT sum(round(n * (bad::DOUBLE / n - m) * (bad::DOUBLE / n - m) - m * (1 - m), 9)::DECIMAL(38, 9))::DOUBLE AS o, sum(round((n - 1) * (m * (1 - m)), 9)::DECIMAL(38, 9))::DOUBLE AS v FROM {name}_m WHERE n > 0))),
{name} AS (SELECT *, k + n AS s, round((m * k + bad) / (k + n), 9) AS rate FROM {name}_m CROSS JOIN {name}_k)"""


SQL = (
    rf"""
WITH p0 AS (SELECT page_id, regexp_replace(lower(regexp_extract(coalesce(url, ''), '{_HOST}', 1)), '^www[.]|[.]$', '', 'g') AS host FROM pages),
p1 AS (SELECT *, CASE WHEN regexp_matches(host, '{_NUMERIC}') THEN host WHEN regexp_matches(regexp_extract(host, '(^|[.])([^.]+[.][^.]+)$', 2), '^{_TWO}|{_GENERIC}') THEN regexp_extract(host, '(^|[.])([^.]+[.][^.]+)$', 2) ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix FROM p0),
p AS (SELECT *, CASE WHEN length(host) <= length(suffix) THEN host ELSE regexp_extract(substr(host, 1, length(host) - length(suffix) - 1), '([^.]*)$', 1) || '.' || suffix END AS domain FROM p1),
y AS (SELECT doc_id AS page_id, count(*) AS n, sum((quality = 0)::BIGINT) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY 1),
hosts AS (SELECT host, domain, suffix, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(bad), 0)::BIGINT AS bad FROM p LEFT JOIN y USING (page_id) GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM domains GROUP BY ALL),
whole AS (SELECT (coalesce(sum(bad), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2) AS m FROM suffixes),"""
    + _level("s", "suffixes", "", "whole")
    + ", sa AS (SELECT suffix, rate AS m FROM s),"
    + _level("d", "domains", "suffix", "sa")
    + ", da AS (SELECT domain, suffix, rate AS m FROM d),"
    + _level("h", "hosts", "domain, suffix", "da")
    + f""",
q AS (SELECT *, rate * s AS a, (1 - rate) * s AS c, sqrt(rate * (1 - rate) / (s + 1)) AS spread FROM h),
w AS (SELECT *, 2 * (c - a) * sqrt(s + 1) / ((s + 2) * sqrt(a * c)) AS skew, 6 * ((a - c) * (a - c) * (s + 1) - a * c * (s + 2)) / (a * c * (s + 2) * (s + 3)) AS excess FROM q),
b AS (SELECT host, n, bad, round(rate, 6) AS rate, round(greatest(0.0, rate + spread * (-{Z} + ({Z} * {Z} - 1) * skew / 6 + (3 * {Z} - {Z} * {Z} * {Z}) * excess / 24 - (5 * {Z} - 2 * {Z} * {Z} * {Z}) * skew * skew / 36)), 6) AS lower FROM w)
SELECT page_id, host, domain, suffix, b.n, b.bad, b.rate, b.lower, b.lower <= {LIMIT} AS keep FROM p JOIN b USING (host)
"""
)
