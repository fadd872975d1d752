"""URL filters: fixed rules first, empirical-Bayes host reputation for the rest.

A rule (host, path prefix, verdict) labels the pages it fits. The share of
blocked pages of a host is then estimated from these outcomes with
beta-binomial priors: a host's prior is centred on the rate of its registered
domain, the domain's on that of its public suffix, the suffix's on the rate of
all labelled pages. How strongly a level holds to its parent (the prior's
weight) is estimated from the data, by the method of moments over all units of
that level. A page without a rule is blocked if its host's rate is high
*surely*: if a lower bound of the posterior passes the limit.

Everything is an aggregation by host, domain or suffix; rows travel once, to
meet their host's verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanekit.llm.common import fresh, stage

#: (host, path prefix, verdict): fits the host and its subdomains.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MAX_RULES = 10_000
#: Labels below a two-letter top level that make a public suffix of two labels.
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gov", "mil", "ne", "net", "nom", "or", "org", "sch")
#: A host is blocked if its posterior rate passes LIMIT at DEVIATIONS standard
#: deviations below its mean. By Cantelli's inequality the true rate lies below
#: that point with a probability of 1 / (1 + DEVIATIONS ** 2) at most.
LIMIT, DEVIATIONS = 0.5, 2.0
#: Bounds of a prior's weight, in pages.
LEAST_WEIGHT, MOST_WEIGHT = 0.5, 1000.0


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end,
    A-Z lower-cased; empty for null or without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or
    without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_name(host: Column) -> Column:
    """The host without user information, port and closing dot."""
    return F.regexp_replace(host, r"(?s)^.*@|:[0-9]*$|\.$", "")


def public_suffix(name: Column) -> Column:
    """The last label, or the last two if they are like ``co.uk``; the whole
    of an IPv4 address."""
    two = rf"^(?:.*\.)?((?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}})$"
    found = F.regexp_extract(name, two, 1)
    return (F.when(name.rlike(r"^[0-9.]+$"), name).when(found != "", found)
            .otherwise(F.substring_index(name, ".", -1)))


def registered_domain(name: Column, suffix: Column) -> Column:
    """The suffix and one label more (the suffix itself if there is none)."""
    above = F.left(name, F.length(name) - F.length(suffix) - 1)
    return F.when(F.length(name) > F.length(suffix) + 1,
                  F.concat(F.substring_index(above, ".", -1), F.lit("."), suffix)).otherwise(suffix)


def fitting_rule(host: Column, path: Column, candidates: Column) -> Column:
    """The longest of ``candidates`` (structs host, path, verdict) whose path
    begins the page's; the longer host wins between rules of one length. Null
    if none fits."""
    fits = F.filter(candidates, lambda r: F.startswith(path, r["path"]))
    ranked = F.transform(fits, lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("size"), F.length(r["host"]).alias("host_size"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict")))
    return F.array_max(ranked)


def rules_by_host(hosts: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """``hosts`` (host) -> (host, candidates): the rules of the host and of
    the domains above it. Every host is looked up label by label, so the work
    does not grow with the number of rules; these are a parameter, at most
    ``MAX_RULES``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    table = hosts.sparkSession.createDataFrame([tuple(r) for r in rules], "at string, path string, verdict string")
    table = table.groupBy("at").agg(F.collect_list(F.struct(F.col("at").alias("host"), "path", "verdict")).alias("of"))
    labels = F.split("host", r"\.")
    above = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("at"))
    return above.join(F.broadcast(table), "at").groupBy("host").agg(F.flatten(F.collect_list("of")).alias("candidates"))


def prior_weight(units: DataFrame) -> float:
    """The beta prior's weight, in pages, for ``units`` (n, blocked, mean):
    ``blocked`` of ``n`` labelled pages where ``mean`` of them was expected.

    Under a beta-binomial the squared distance to the expectation has mean
    n m (1 - m) (1 + (n - 1) rho); rho = 1 / (weight + 1) follows from the
    sums over all units. Units alike: a heavy prior; units of their own: a
    light one. Without evidence (no unit has two pages, or all outcomes are
    alike) the prior is as light as it may be.
    """
    spread = F.col("n") * F.col("mean") * (1 - F.col("mean"))
    seen, plain, extra = units.filter("n > 0").agg(
        F.sum((F.col("blocked") - F.col("n") * F.col("mean")) ** 2), F.sum(spread),
        F.sum(spread * (F.col("n") - 1))).first()
    if not extra:
        return LEAST_WEIGHT
    rho = (seen - plain) / extra
    return MOST_WEIGHT if rho <= 1 / (MOST_WEIGHT + 1) else max(LEAST_WEIGHT, 1 / rho - 1)


def posterior_means(units: DataFrame, parents: DataFrame | None, keys: list, start: float) -> tuple[DataFrame, float]:
    """``units`` (keys.., n, blocked) with their prior mean (the parent's
    posterior mean, or ``start``) and posterior mean ``rate``, and the prior's
    weight."""
    above = F.lit(start) if parents is None else F.col("above")
    joined = units if parents is None else units.join(parents, keys[:-1])
    joined = joined.select(*keys, "n", "blocked", above.alias("mean"))
    weight = prior_weight(joined)
    rate = (weight * F.col("mean") + F.col("blocked")) / (weight + F.col("n"))
    return joined.withColumn("rate", rate), weight


def reputation(hosts: DataFrame, limit: float = LIMIT, deviations: float = DEVIATIONS) -> DataFrame:
    """``hosts`` (host, n, blocked: labelled pages and blocked ones; 0 where
    there are none) -> host, rate (posterior mean), bound (lower bound of the
    rate) and surely_bad (bound over ``limit``), a row per host.

    With no labelled page at all every host has the rate 1/2 and is not
    surely bad.
    """
    name = host_name(F.col("host"))
    suffix = public_suffix(name)
    placed = stage(hosts.select("host", "n", "blocked", suffix.alias("suffix"), registered_domain(name, suffix).alias("domain")),
                   "url-hosts")
    sums = [F.sum("n").alias("n"), F.sum("blocked").alias("blocked")]
    domains = stage(placed.groupBy("suffix", "domain").agg(*sums), "url-domains")
    suffixes = stage(domains.groupBy("suffix").agg(*sums), "url-suffixes")
    n, blocked = suffixes.agg(*[F.coalesce(s, F.lit(0)) for s in sums]).first()
    by_suffix, _ = posterior_means(suffixes, None, ["suffix"], (blocked + 0.5) / (n + 1))
    by_domain, _ = posterior_means(domains, by_suffix.select("suffix", F.col("rate").alias("above")), ["suffix", "domain"], 0.0)
    by_host, weight = posterior_means(placed, by_domain.select("suffix", "domain", F.col("rate").alias("above")),
                                      ["suffix", "domain", "host"], 0.0)
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (weight + F.col("n") + 1))
    return (by_host.withColumn("bound", F.col("rate") - deviations * deviation)
            .select("host", "rate", "bound", (F.col("bound") > limit).alias("surely_bad")))


def judged(pages: DataFrame, rules: Sequence[tuple] = RULES, limit: float = LIMIT,
           deviations: float = DEVIATIONS) -> DataFrame:
    """page_id, host, path, rule, verdict, rate and bound for every row of
    ``pages`` (columns page_id, url; others are ignored).

    ``rule`` is the host and path of the longest rule that fits, and its
    verdict counts; without one ``rule`` is null and the host's reputation
    decides: ``block`` if the posterior's lower bound of its share of blocked
    pages passes ``limit``, else ``allow``. Only pages with a rule are
    labelled outcomes. Null urls and urls without ``://`` have an empty host
    and path and share the reputation of the empty host; repeated rows and ids
    are rows of their own (and outcomes of their own). No rows in, none out.
    """
    page, path = fresh("page"), fresh("path")
    narrow = pages.select(F.col("page_id").alias(page), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias(path))
    names = stage(narrow.groupBy("host").agg(F.count("*").alias("pages")), "url-names")
    candidates = stage(names.select("host").join(rules_by_host(names.select("host"), rules), "host", "left"), "url-rules")
    # a row per host on the right: a host of very many pages is split on the left
    ruled = stage(narrow.join(candidates, "host").select(
        page, "host", path, fitting_rule(F.col("host"), F.col(path), F.col("candidates")).alias("found")), "url-ruled")
    blocked = (F.col("found")["verdict"] == "block").cast("long")
    outcomes = ruled.groupBy("host").agg(F.count("found").alias("n"), F.coalesce(F.sum(blocked), F.lit(0)).alias("blocked"))
    known = stage(reputation(outcomes, limit, deviations), "url-reputation")
    own = F.when(F.col("surely_bad"), "block").otherwise("allow")
    return ruled.join(known, "host").select(
        F.col(page).alias("page_id"), "host", F.col(path).alias("path"), F.col("found")["rule"].alias("rule"),
        F.coalesce(F.col("found")["verdict"], own).alias("verdict"), "rate", "bound")
