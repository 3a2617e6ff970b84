"""URL filters: host rules, and for the rest reputations by empirical Bayes.

Labelled pages give each host, registered domain and suffix a number of bad outcomes out of
all. On each level the bad rate of a name has a beta prior around the rate of the level above
(host around its domain, domain around its suffix, suffix around all pages); the prior's weight
is fitted to how much the names of the level differ from their parents. A page is blocked where
a bound of the host's posterior bad rate is too high.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import quoted, staged

# Second-level suffixes under which names are registered, besides the last label. Fixed values.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn",
            "com.mx", "com.tr", "gov.uk", "net.au", "ne.jp", "or.jp", "org.au", "org.uk")


# So many hosts with their reputation take about 10 MB and may be broadcast.
_BROADCAST_HOSTS = 100_000


@dataclass(frozen=True)
class Rule:
    """``host`` + ``path``, e.g. ``example.com/en/``: its host with all subdomains, and the
    urls whose path starts with its path."""

    allow: bool
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def _lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case. Path:
    from there up to ``?``, ``#`` or the end. Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return _lowered(host), path


def matching_rule(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """The longest rule that fits, as a struct (text, allow); null without one. Of rules that
    are equally long the first in the alphabet counts."""
    found = F.lit(None).cast("struct<text:string,allow:boolean>")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits &= F.startswith(path, F.lit(rule.path))
        one = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.allow).alias("allow"))
        found = F.when(fits, one).otherwise(found)
    return found


def registered_domain(host: Column, suffixes: Iterable[str] = SUFFIXES) -> tuple[Column, Column]:
    """(domain, suffix) of a host: the suffix is one of ``suffixes`` or the last label; the
    domain has one label more, or is the host itself if that has none."""
    labels = F.split(host, r"\.")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    n = F.when(two.isin(list(suffixes)), 2).otherwise(1)
    suffix = F.when(F.size(labels) <= n, host).otherwise(
        F.array_join(F.slice(labels, -n, n), ".")
    )
    domain = F.when(F.size(labels) <= n, host).otherwise(
        F.array_join(F.slice(labels, -n - 1, n + 1), ".")
    )
    return domain, suffix


def _shrunk(names: DataFrame, least: float, most: float) -> DataFrame:
    """Counts by name of a level with the posterior mean of the bad rate and its prior's weight.

    ``names`` has bad, n, and the parent's mean as ``prior``. The weight is the one at which
    the names' scatter around their priors has the size the beta-binomial expects (method of
    moments), within ``least`` and ``most``. One number reaches the driver.
    """
    p, n = F.col("prior"), F.col("n")
    found = names.agg(
        F.sum(F.pow(F.col("bad") - n * p, 2)).alias("scatter"),
        F.sum(n * p * (1 - p)).alias("chance"),
        F.sum(n * (n - 1) * p * (1 - p)).alias("pairs"),
    ).first()
    weight = most
    if found.pairs and found.scatter > found.chance:
        # scatter = chance + pairs / (weight + 1)
        weight = min(max(found.pairs / (found.scatter - found.chance) - 1, least), most)
    mean = (F.col("bad") + weight * p) / (n + weight)
    return names.withColumns({"mean": mean, "weight": F.lit(float(weight))})


def reputations(
    outcomes: DataFrame, suffixes: Iterable[str] = SUFFIXES, least=1.0, most=1000.0
) -> DataFrame:
    """Bad rates of hosts from ``outcomes`` (host, bad 0/1): columns level (host, domain,
    suffix or all), name, bad, n, mean, sd (standard deviation of the posterior).

    Empty or null hosts and null outcomes are left out. Pages are summed by host before any
    other step. ``least`` and ``most`` bound the weights of the priors, in pages.
    """
    known = outcomes.where("host <> '' AND bad IN (0, 1)")
    domain, suffix = registered_domain(F.col("host"), suffixes)
    hosts = known.groupBy("host").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
    hosts = staged(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")

    def summed(*by):
        return hosts.groupBy(*by).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))

    total = hosts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    # One page each way keeps the rate off 0 and 1.
    base = ((total.bad or 0) + 1) / ((total.n or 0) + 2)
    tops = _shrunk(summed("suffix").withColumn("prior", F.lit(base)), least, most)
    prior = tops.select("suffix", F.col("mean").alias("prior"))
    middles = _shrunk(summed("domain", "suffix").join(prior, "suffix"), least, most)
    prior = middles.select("domain", F.col("mean").alias("prior"))
    leaves = _shrunk(hosts.join(prior, "domain"), least, most)
    everything = hosts.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).where("n > 0")
    everything = everything.withColumns({"mean": F.lit(base), "weight": F.lit(2.0)})

    def rows(frame, level, name):
        spread = F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("weight") + 1)
        return frame.select(
            F.lit(level).alias("level"), name.alias("name"), "bad", "n", "mean", F.sqrt(spread).alias("sd")
        )

    return (
        rows(leaves, "host", F.col("host"))
        .unionByName(rows(middles, "domain", F.col("domain")))
        .unionByName(rows(tops, "suffix", F.col("suffix")))
        .unionByName(rows(everything, "all", F.lit("")))
    )


def judge(
    pages: DataFrame,
    rules: Iterable[Rule],
    outcomes: DataFrame,
    block_above=0.3,
    z=1.645,
    url="url",
    suffixes: Iterable[str] = SUFFIXES,
) -> DataFrame:
    """Every page with host, path, rule, verdict, and the reputation the verdict rests on.

    Columns: page (struct of all columns of ``pages``), host, path, rule (text or null),
    verdict (allow or block), level and bound. The longest rule decides; without one a page is
    blocked where mean - ``z`` standard deviations, the lower bound of its bad rate, is above
    ``block_above``: few bad pages do not condemn a host. A host without labelled pages is judged by its domain, else its suffix,
    else all pages; without any labels, or without a host, it is allowed. Null urls have empty
    host and path. ``outcomes``: (host, bad), see :func:`reputations`.
    """
    host, path = host_and_path(F.coalesce(quoted(url).cast("string"), F.lit("")))
    rows = pages.select(
        F.struct(*[quoted(c).alias(c) for c in pages.columns]).alias("page"),
        host.alias("host"),
        path.alias("path"),
    )
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    known = reputations(outcomes, suffixes).withColumn("bound", F.col("mean") - z * F.col("sd"))

    # Reputations are looked up once per host, not per page.
    domain, suffix = registered_domain(F.col("host"), suffixes)
    hosts = rows.where("host <> ''").select("host").distinct()
    steps = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(level).alias("level"), name.alias("name"))
            for i, (level, name) in enumerate(
                [("host", F.col("host")), ("domain", domain), ("suffix", suffix), ("all", F.lit(""))]
            )
        ]
    )
    asked = hosts.select("host", F.inline(steps))
    judged = (
        asked.join(known, ["level", "name"])
        .groupBy("host")
        .agg(F.min_by(F.struct("level", "bound"), "step").alias("reputation"))
        .select("host", "reputation.level", "reputation.bound")
    )
    judged = staged(judged, "judged")
    if judged.count() <= _BROADCAST_HOSTS:
        # Pages then stay where they are; else Spark joins, and splits, a host of many pages.
        judged = F.broadcast(judged)
    by_method = F.when(F.col("bound") > block_above, "block").otherwise("allow")
    by_rule = F.when(F.col("rule.allow"), "allow").otherwise("block")
    return rows.join(judged, "host", "left").select(
        "page",
        "host",
        "path",
        F.col("rule.text").alias("rule"),
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_method).alias("verdict"),
        "level",
        "bound",
    )
