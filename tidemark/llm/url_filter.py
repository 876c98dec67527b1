"""URL filters: block and allow rules by host and path, and the reputation of hosts by empirical Bayes.

Labelled page outcomes (1 good, 0 bad) are counted per host, registered domain and public suffix. A host's beta-binomial prior
comes down this tree, and at every step from the pages of others only: from all pages outside its suffix to the suffix without
its domain, to the domain without the host, to the host. A step takes the mean and the variance of the level above, adds the
spread of the groups of its own level, estimated by moments from all of them, makes a beta prior of both and updates it by the
level's counts. So one page weighs little whatever the level, and what is not known above stays uncertain below. A host is
blocked when even the upper bound of its posterior lies below a threshold.
Everything is built-in column expressions; counts combine before they are shuffled, so a hot host costs one row a task.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is judged by the
prior of the empty host; pages without outcome only name their host; without any outcome every host is allowed; repeated rows
are judged alike, each one for itself; columns beside those named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, stored

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Suffixes of two labels under which domains are registered (fixed values; the caller may give others).
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10000.0


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return lower_ascii(host), path


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else null; of equally long ones, that with the longer host.
    A rule list is a handful of literals; give a table of millions as outcomes instead."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def levels(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    two = F.concat_ws(".", F.slice(labels, F.greatest(n - 1, F.lit(1)), 2))
    depth = F.when(two.isin(*suffixes), 2).otherwise(1)
    tail = lambda k: F.concat_ws(".", F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k))
    return tail(depth + 1), tail(depth)


def _strength(rows: DataFrame, level: str, above: str) -> float:
    """How alike the groups of a level are, as a prior's number of pages: by moments, how far their shares of good pages spread,
    beyond chance, around the share of the other pages of the group above. Rows have the counts of both and ``rate``."""
    good, n = F.col(f"good_{level}"), F.col(f"n_{level}")
    centre = (F.col(f"good_{above}") - good + F.col("rate")) / (F.col(f"n_{above}") - n + 1)
    row = (rows.where(n > 0).select(F.sum(n * (good / n - centre) * (good / n - centre)), F.sum(centre * (1 - centre)),
                                    F.sum(n * centre * (1 - centre))).first())  # one row of sums
    spread, chance, top = (float(x or 0) for x in row)
    between = (spread - chance) / (top - chance) if top > chance else 0.0
    return min(STRONGEST, max(WEAKEST, 1 / between - 1)) if between > 0 else STRONGEST


def updated(mean: Column, variance: Column, strength: Column, good: Column, n: Column) -> tuple[Column, Column]:
    """Posterior mean and variance of a group with so many good of n pages, whose share spreads with ``strength`` around one
    known by its mean and variance."""
    spread = mean * (1 - mean)
    prior = (spread - variance) / (strength + 1) + variance
    weight = spread / prior - 1
    after = (weight * mean + good) / (weight + n)
    return after, after * (1 - after) / (weight + n + 1)


def reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES, bound: float = 1.96) -> DataFrame:
    """``outcomes`` has host and good (0 or 1; null: no outcome, which still names the host). Gives per host: n, good,
    mean, low, high. A host without outcomes has what is known of its domain, a new domain what is known of its suffix.

    Four one-row sums come to the driver; nothing else does."""
    domain, suffix = levels(F.col("host"), suffixes)
    hosts = (outcomes.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.coalesce(F.sum(F.col("good").cast("double")), F.lit(0.0)).alias("good_host"),
                  F.count("good").cast("double").alias("n_host"))
             .withColumns({"domain": domain, "suffix": suffix}))
    hosts = stored(hosts, "hosts")  # read once for each level
    total = hosts.agg(F.sum("good_host"), F.sum("n_host")).first()
    rate = ((total[0] or 0) + 1) / ((total[1] or 0) + 2)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("good_host").alias("good_domain"), F.sum("n_host").alias("n_domain"))
    tops = domains.groupBy("suffix").agg(F.sum("good_domain").alias("good_suffix"), F.sum("n_domain").alias("n_suffix"))
    tops = tops.withColumns({"good_all": F.lit(total[0] or 0.0), "n_all": F.lit(total[1] or 0.0), "rate": F.lit(rate)})
    domains = stored(domains.join(tops, "suffix"), "domains")
    full = hosts.join(domains.drop("suffix"), "domain")
    strength = {"suffix": _strength(tops, "suffix", "all"), "domain": _strength(domains, "domain", "suffix"),
                "host": _strength(full, "host", "domain")}
    others = lambda what, level, own: F.col(f"{what}_{level}") - F.col(f"{what}_{own}")
    n_out = others("n", "all", "suffix")
    mean = (others("good", "all", "suffix") + 1) / (n_out + 2)
    variance = mean * (1 - mean) / (n_out + 3)
    for level, below in (("suffix", "domain"), ("domain", "host"), ("host", None)):
        good, n = ((F.col("good_host"), F.col("n_host")) if below is None
                   else (others("good", level, below), others("n", level, below)))
        full = full.withColumns(dict(zip(("mean", "variance"), updated(mean, variance, F.lit(strength[level]), good, n))))
        mean, variance = F.col("mean"), F.col("variance")
    sd = F.sqrt("variance")
    return full.select("host", F.col("n_host").alias("n"), F.col("good_host").alias("good"), "mean",
                       (mean - bound * sd).alias("low"), (mean + bound * sd).alias("high"))


def filtered(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = 0.5,
             bound: float = 1.96, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, reputation (posterior mean of its host, null if ``outcomes`` lacks
    it). ``outcomes`` has host and good. A rule decides where one fits; else the host's posterior bound."""
    host, path = parts(F.col(url))
    known = reputation(outcomes, bound=bound).select(F.col("host").alias("_host"), "mean", "high")
    shown = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = F.when(F.col("high") < threshold, "block").otherwise("allow")
    return (shown.join(known, F.col("host") == F.col("_host"), "left")
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict"),
                    F.col("mean").alias("reputation")))


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host and good of every page. The number in the path names the page's document: good is 1 if that is labelled
    quality 1 and not toxic, 0 if labelled otherwise, null without label. Repeated label rows count as the worst."""
    host, path = parts(F.col("url"))
    number = F.expr("try_cast(nullif(regexp_extract(_path, '^/[^/]*/([0-9]+)', 1), '') as bigint)")
    shown = pages.select(host.alias("host"), path.alias("_path")).select("host", number.alias("doc_id"))
    good = labels.groupBy("doc_id").agg(F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1)
                                              .otherwise(0)).alias("good"))
    return shown.join(good, "doc_id", "left").select("host", "good")
