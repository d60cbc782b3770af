"""URL filter: empirical-Bayes reputation of hosts under explicit allow and block rules.

Labelled page outcomes are shrunk through beta-binomial priors from suffix to registered domain to host, and a
host is blocked when the lower bound of its posterior rate of bad pages is above a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, materialize

#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "co.kr", "co.in",
    "com.br", "com.mx", "com.ar", "com.cn", "com.hk", "com.sg", "com.tr", "com.tw", "co.za", "co.il",
)


@dataclass(frozen=True)
class Rule:
    """An explicit verdict for a host, its subdomains and the paths that start with `path`."""

    action: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))).otherwise("")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def domain_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; an address of digits is its own domain and has no suffix."""
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")
    two = last(2).isin(*TWO_LABEL_SUFFIXES)
    numeric = bare.rlike(r"^[0-9.]+$")
    return (
        F.when(numeric, bare).when(two, last(3)).otherwise(last(2)),
        F.when(numeric, F.lit("")).when(two, last(2)).otherwise(last(1)),
    )


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits; of equally long ones that with the longer host, then a block."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.action == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, action = F.when(fits, r.text).otherwise(text), F.when(fits, r.action).otherwise(action)
    return text, action


def _strength(level: DataFrame, lo: float, hi: float) -> float:
    """Prior strength of a level by the method of moments: over-dispersion of its rates around their parents' means."""
    mu = F.col("parent")
    row = level.filter("n > 0").agg(
        F.sum((F.col("k") - F.col("n") * mu) ** 2 / (F.col("n") * mu * (1 - mu))).alias("x2"), F.count("*").alias("i"), F.sum(F.col("n") - 1).alias("e")
    ).first()
    rho = (row["x2"] - row["i"]) / row["e"] if row["e"] else 0.0
    return min(max(1 / rho - 1 if rho > 0 else hi, lo), hi)


def host_reputation(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = (), *, id_col: str = "page_id", url_col: str = "url",
    block_at: float = 0.3, z: float = 1.645, strength: tuple[float, float] = (1.0, 1000.0),
) -> DataFrame:
    """Judge every page's url.

    pages: id_col, url_col and any other columns, which are ignored. outcomes: columns `id` and `bad` (0 or 1); several
    rows of an id count as their largest, and ids without a page count nowhere. A page without outcome is unlabelled.
    rules: a few hundred at most, as they become one expression; larger lists belong in a table joined by host suffix.

    Returns page_id (id_col), host, path, rule, verdict, n_labelled, bound: one row for each row of pages. A null url has
    empty host and path and shares the reputation of the empty host; a repeated page counts as often as it stands; with
    no labelled page the prior mean is 1/2 and the bound is far below it, so nothing is blocked.
    """
    url = F.col(url_col)
    p = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    p = p.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    seen = outcomes.groupBy(F.col("id").alias("page_id")).agg(F.max("bad").alias("bad"))
    hosts = p.join(seen, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    domain, suffix = domain_of(F.col("host"))
    hosts = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")

    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("parent", F.lit((total["k"] + 1) / (total["n"] + 2)))

    def posterior(level: DataFrame) -> DataFrame:
        m = _strength(level, *strength)
        return level.withColumns({"a": m * F.col("parent") + F.col("k"), "b": m * (1 - F.col("parent")) + F.col("n") - F.col("k")})

    mean = (F.col("a") / (F.col("a") + F.col("b"))).alias("parent")
    suffixes = posterior(suffixes)
    domains = posterior(domains.join(suffixes.select("suffix", mean), "suffix"))
    hosts = posterior(hosts.join(domains.select("suffix", "domain", mean), ["suffix", "domain"]))
    a, b = F.col("a"), F.col("b")
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    hosts = hosts.select("host", F.col("n").alias("n_labelled"), bound.alias("bound"))

    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    judged = p.withColumns({"rule": rule, "action": action}).join(hosts, "host", "left")
    verdict = F.coalesce("action", F.when(F.col("bound") > block_at, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n_labelled", F.round("bound", 6).alias("bound"))
