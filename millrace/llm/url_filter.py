"""URL filters: rules, and for the rest trust and distrust that flow along links between hosts.

The most specific rule judges a page. Hosts get trust by personalised PageRank from pages that a rule allows,
along links, and distrust from pages that a rule blocks, against the links (who links to bad hosts is suspect).
Links come from the pages' ``href`` attributes; a relative one stays on its host. Each host also has a link to
and from the host one label up, if that one is a known host, as sites share their names. A page without
a rule is blocked if its host has more distrust than trust and at least ``THRESHOLD`` of it, times the mean
mass of a host; otherwise it is allowed. Ranks are iterated until all hosts together change by less than
``TOLERANCE`` of the mean mass of one host.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import kept, registered, table


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))
DAMPING, TOLERANCE, THRESHOLD = 0.85, 1e-3, 0.5
#: Links that are followed out of one page count by host, however often they repeat.
_LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _fits(rule: Rule) -> Column:
    host, path = F.col("host"), F.col("path")
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def with_rule(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``rule``, the longest that fits (of equal ones the first by name), and ``ruled``, its verdict."""
    by_length = sorted(rules, key=lambda r: (-len(r.name), r.name))
    name = F.coalesce(*(F.when(_fits(r), r.name) for r in by_length), F.lit(None).cast("string")) if rules else F.lit(None).cast("string")
    ruled = F.coalesce(*(F.when(_fits(r), r.verdict) for r in by_length), F.lit(None).cast("string")) if rules else F.lit(None).cast("string")
    return pages.withColumns({"rule": name, "ruled": ruled})


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): distinct pages of a host that link to another host; ``pages`` has host and html."""
    found = pages.where("host <> ''").select("host", F.explode(F.array_distinct(
        F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), 1), _target))).alias("dst"))
    across = found.where("dst <> '' AND dst <> host")
    return across.groupBy(F.col("host").alias("src"), "dst").agg(F.count("*").cast("double").alias("weight"))


def _target(link: Column) -> Column:
    """The host that an absolute link names, also one without a scheme; empty for relative ones."""
    full = F.when(link.startswith("//"), F.concat(F.lit("http:"), link)).otherwise(link)
    return F.when(full.rlike("^(?i)(?:https?:)//"), host_of(full)).otherwise("")


def _site_links(hosts: DataFrame) -> DataFrame:
    """Links between a host and the host one label up, both ways, where that is a known host."""
    up = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("parent")).where("parent <> ''")
    known = up.join(hosts.select(F.col("host").alias("parent")), "parent")
    return known.select(F.col("host").alias("src"), F.col("parent").alias("dst"), F.lit(1.0).alias("weight")).unionByName(
        known.select(F.col("parent").alias("src"), F.col("host").alias("dst"), F.lit(1.0).alias("weight")))


def personalised_rank(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = 1e-6) -> DataFrame:
    """(host, mass): PageRank with restarts at ``seeds`` (host, mass), until a round moves less than ``tolerance`` in all.

    A host's mass is added up before the shuffle and joined by host, so one that very many hosts link to is no
    hot key. Hosts without links return their mass to the seeds, in the share of the seeds' masses.
    """
    total = seeds.agg(F.sum("mass")).first()[0]
    if not total:
        return seeds.sparkSession.createDataFrame([], "host string, mass double")
    moved = kept(seeds.groupBy("host").agg((F.sum("mass") / F.lit(float(total))).alias("seed")).select(
        "host", F.lit(0.0).alias("got"), "seed"), "seeds")
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    steps = kept(links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")), "steps")
    if steps.isEmpty():
        return moved.select("host", F.col("seed").alias("mass"))
    rest = 1.0  # restarts, and what dead ends give back
    # changes shrink by the damping each round, so they are below the tolerance by then
    for k in range(math.ceil(math.log(tolerance / 8) / math.log(damping)) + 2):
        ranks = moved.select("host", (F.col("got") + F.lit(rest) * F.col("seed")).alias("mass"))
        sent = ranks.join(steps, ranks["host"] == steps["src"]).groupBy(F.col("dst").alias("host")).agg(
            (F.sum(F.col("mass") * F.col("share")) * damping).alias("got"))
        moved = kept(sent.join(moved.select("host", F.col("got").alias("before"), "seed"), "host", "full").select(
            "host", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("got", "before", "seed"))), f"rank-{k}")
        received, change = moved.agg(F.sum("got"), F.sum(F.abs(F.col("got") - F.col("before")))).first()
        rest = 1.0 - (received or 0.0)
        if 2 * (change or 0.0) < tolerance:  # the restarts change by no more than the links
            return moved.select("host", (F.col("got") + F.lit(rest) * F.col("seed")).alias("mass"))
    raise RuntimeError("the ranks of hosts do not settle")


def host_verdicts(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, blocked) of every host; ``pages`` has host, html and ruled."""
    counts = kept(pages.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.sum(F.when(F.col("ruled") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.sum(F.when(F.col("ruled") == "block", 1.0).otherwise(0.0)).alias("blocked")), "hosts")
    links = kept(host_links(pages).unionByName(_site_links(counts.select("host"))), "links")
    reverse = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    # a host's part of a seed is the share of its pages that a rule judges so
    n = max(1, counts.count())
    trust = personalised_rank(links, counts.where("allowed > 0").select("host", (F.col("allowed") / F.col("pages")).alias("mass")), tolerance=TOLERANCE / n)
    distrust = personalised_rank(reverse, counts.where("blocked > 0").select("host", (F.col("blocked") / F.col("pages")).alias("mass")), tolerance=TOLERANCE / n)
    both = counts.join(trust.withColumnRenamed("mass", "trust"), "host", "left").join(
        distrust.withColumnRenamed("mass", "distrust"), "host", "left").na.fill(0.0, ["trust", "distrust"])
    return both.select("host", "trust", "distrust", (
        (F.col("distrust") > F.col("trust")) & (F.col("distrust") * n >= threshold)).alias("blocked"))


def judged_pages(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", html: str = "html", page_id: str = "page_id") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row per input row.

    Pages without a host fit no rule and are allowed; so are hosts that neither trust nor distrust reaches. Null
    html has no links. Repeated and null ids are judged row by row. Other columns are ignored.
    """
    parts = pages.select(
        F.col(page_id).cast("long").alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
        F.col(html).cast("string").alias("html"))
    ruled = with_rule(parts, rules)
    verdicts = kept(host_verdicts(ruled), "verdicts")
    slim = ruled.drop("html").join(verdicts, "host", "left")
    verdict = F.coalesce("ruled", F.when(F.col("blocked"), "block").otherwise("allow"))
    return slim.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                       F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


@registered()
def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """All pages with their rule and verdict."""
    return judged_pages(table(spark, folder, "pages"))
