"""URL filter by rules and the empirical-Bayes reputation of hosts.

Labelled outcomes of pages (bad or not) are counted by host, registered domain and
public suffix. Each level's rates are shrunk towards the level above through a
beta-binomial prior: its mean is the posterior mean above, its strength is fitted
to the spread of the level's rates by the method of moments. A host is blocked if
the lower bound of its posterior bad rate reaches a threshold. Hosts without
labels have their domain's posterior, and so on up to the overall rate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import cut, lower_ascii

#: Public suffixes of more than one label that hosts are registered under, unless others are given (fixed values).
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "ne.jp", "ac.jp",
    "com.br", "com.cn", "com.mx", "com.tr", "com.ar", "co.in", "co.kr", "co.za",
)
#: Standard deviations below the posterior mean; the bound from which a host is blocked.
Z, BLOCK_FROM = 1.645, 0.5
#: Range of a prior's strength, in labelled pages.
WEAKEST, STRONGEST = 1.0, 1000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does. Of equally long ones the last in the alphabet."""
    text = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        text, verdict = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """Public suffix: one of two labels that is listed, or the last label."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """Registered domain: the suffix and one label more, as far as the host has one."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(rates: DataFrame) -> float:
    """Prior strength of a level's (n, bad) by moments: what spread exceeds that of equal rates. Exact decimal sums."""
    n, k = F.col("n"), F.col("bad")
    some = rates.where("n > 0").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum(n).alias("n"),
        F.sum(k).alias("k"),
        F.sum((n * n).cast("decimal(38,0)")).alias("nn"),
        F.sum((k * k / n).cast("decimal(28,9)")).alias("kk"),
    ).first()
    if not some or some["units"] < 2 or some["n"] <= some["units"]:
        return STRONGEST
    units, total, bad, nn, kk = (float(x) for x in some)
    between = (kk - bad * bad / total) / (units - 1)
    within = (bad - kk) / (total - units)
    size = (total - nn / total) / (units - 1)
    spread = between + (size - 1) * within
    share = (between - within) / spread if spread > 0 else 0.0
    return STRONGEST if share <= 0 else min(STRONGEST, max(WEAKEST, (1 - share) / share))


def _mean(parent: Column, strength: float) -> Column:
    return (parent * strength + F.col("bad")) / (F.col("n") + strength)


def reputations(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", suffixes: Sequence[str] = SUFFIXES
) -> DataFrame:
    """``host``, ``domain``, ``suffix``, ``n`` (labelled pages), ``bad``, ``bad_rate`` and ``bad_bound`` of every host.

    ``labels`` has the id in ``doc_id``; a page is bad if a label of it says toxic 1
    or quality 0. A page that is repeated counts as often as it is in ``pages``;
    ids that are null have no label.
    """
    bad = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max(((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).cast("int")).alias("bad")
    )
    # Pages are added up by id and host first, so a hot page or host is one row of each task.
    counted = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host")).groupBy("id", "host").count()
    hosts = counted.join(bad, "id", "left").groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("count"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("bad") * F.col("count")), F.lit(0)).alias("bad"),
    )
    name = F.col("host")
    hosts = cut(hosts.select("host", domain_of(name, suffixes).alias("domain"), suffix_of(name, suffixes).alias("suffix"), "n", "bad"))
    domains = cut(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    above = cut(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    total = above.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = float(total["bad"] or 0) / float(total["n"]) if total and total["n"] else 0.0
    of_suffix = above.select("suffix", _mean(F.lit(overall), _strength(above)).alias("above"))
    of_domain = cut(
        domains.join(of_suffix, "suffix").select("domain", _mean(F.col("above"), _strength(domains)).alias("above"))
    )
    strength = _strength(hosts)
    rate = _mean(F.col("above"), strength)
    bound = F.greatest(F.lit(0.0), rate - Z * F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1)))
    return hosts.join(of_domain, "domain").select(
        "host", "domain", "suffix", "n", "bad", F.round(rate, 6).alias("bad_rate"), F.round(bound, 6).alias("bad_bound")
    )


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    block_from: float = BLOCK_FROM,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Id, ``host``, ``path``, ``rule``, ``verdict`` (allow or block) and ``bad_bound`` of every row of ``pages``.

    The longest fitting rule decides, else the host's reputation. ``suffixes`` are the
    public suffixes of two labels. Null urls and urls
    without ``://`` have the empty host and path, whose reputation counts like any
    other host's. Repeated rows stay; without labels nothing but rules blocks; an
    empty table gives an empty table; other columns are not read.
    """
    known = cut(reputations(pages, labels, id_col, url_col, suffixes).select(F.col("host").alias("__host"), "bad_bound"))
    named = pages.select(
        F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    text, verdict = rule_for(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_bound") >= block_from, F.lit("block")).otherwise(F.lit("allow"))
    return named.join(known, F.col("host") == F.col("__host"), "left").select(
        id_col, "host", "path", text.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "bad_bound"
    )
