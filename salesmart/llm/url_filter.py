"""URL verdicts from rules and, where no rule fits, from trust and distrust over the host graph.

Trust starts at hosts whose pages rules allow and follows links; distrust starts at hosts whose pages rules block
and follows links backwards, so that who links to bad hosts is suspect. Both are personalised PageRank by a
fixed number of rounds over host edges. A bad host's distrust is divided among all who link to it; so a host is also
judged by its suspicion, the damped share of its own links that lead to bad hosts, however many others link there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.operators.lookups import is_small
from salesmart.storage import Scratch

DAMPING = 0.85
ROUNDS = 12
#: Share of a wholly blocked host's own distrust, and of its suspicion (1), from which a host counts as bad.
SUSPECT = 0.5
DOMAIN_WEIGHT = 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.char_length(rest) + 4, F.char_length(url))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.char_length(rest) + 4, F.char_length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, action) of the longest fitting rule, null if none fits. Rules of equal length: the first listed wins."""
    found = F.lit(None)
    for rule in sorted(reversed(rules), key=lambda rule: len(rule.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, domain_weight: float = DOMAIN_WEIGHT) -> DataFrame:
    """(src, dst, weight) between different hosts: links of their pages, and each host with its parent domains.

    Links are absolute or scheme-relative; a relative one stays on its host. Equal links count once per
    page. Parents have two labels or more.
    """
    links = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))).alias("_to"))
    to = F.translate(F.regexp_replace(F.regexp_replace("_to", r"^.*@", ""), r":[0-9]*$", ""), _UPPER, _LOWER)
    links = links.select(F.col("host").alias("src"), to.alias("dst")).where("src != '' AND dst != '' AND src != dst")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    hosts = pages.select("host").where("host != ''").distinct()
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(2), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = F.concat(F.array("host"), F.when(F.size(labels) > 2, parents).otherwise(F.array().cast("array<string>")))
    steps = hosts.select(chain.alias("_chain")).select(F.explode(F.arrays_zip(F.slice("_chain", F.lit(1), F.size("_chain") - 1).alias("a"), F.slice("_chain", F.lit(2), F.size("_chain") - 1).alias("b"))).alias("_step"))
    steps = steps.select("_step.*").where("a IS NOT NULL AND b IS NOT NULL").distinct()
    both = steps.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(steps.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    domains = both.withColumn("weight", F.lit(float(domain_weight)))
    return links.unionByName(domains).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def ranks(edges: DataFrame, seeds: DataFrame, scratch: Scratch, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust, suspicion) after ``rounds`` steps from ``seeds`` (host, trusted, blocked: 0 to 1).

    rank = (1 - damping) x seed + damping x what its neighbours pass on, each in shares of their edge weights:
    along edges for trust, against them for distrust. What reaches a host without further edges leaves the graph.
    suspicion = blocked + (1 - trusted - blocked) x damping x the mean suspicion of those it has edges to, by weight.
    Rounds are written tables. Contributions are summed before the shuffle; a hub's edges are split by the skew join.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("_all"))
    back = edges.groupBy("dst").agg(F.sum("weight").alias("_all"))
    forward = edges.join(out, "src").select(F.col("src").alias("giver"), F.col("dst").alias("host"), (F.col("weight") / F.col("_all")).alias("_trust"), F.lit(0.0).alias("_distrust"), F.lit(0.0).alias("_suspicion"))
    reverse = edges.join(back, "dst").select(F.col("dst").alias("giver"), F.col("src").alias("host"), F.lit(0.0).alias("_trust"), (F.col("weight") / F.col("_all")).alias("_distrust"), F.lit(0.0).alias("_suspicion"))
    mean = edges.join(out, "src").select(F.col("dst").alias("giver"), F.col("src").alias("host"), F.lit(0.0).alias("_trust"), F.lit(0.0).alias("_distrust"), (F.col("weight") / F.col("_all")).alias("_suspicion"))
    flows = scratch.table(forward.unionByName(reverse).unionByName(mean).groupBy("giver", "host").agg(*[F.sum(name).alias(name) for name in ("_trust", "_distrust", "_suspicion")]), "flows")
    start = lambda name: F.lit(1 - damping) * F.coalesce(F.col(name), F.lit(0.0))
    seed = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    rank = scratch.table(seeds.select("host", start("trusted").alias("trust"), start("blocked").alias("distrust"), seed("blocked").alias("suspicion")), "rank0")
    for n in range(rounds):
        given = flows.join(rank.withColumnRenamed("host", "giver"), "giver")
        given = given.groupBy("host").agg(F.sum(F.col("_trust") * F.col("trust")).alias("_t"), F.sum(F.col("_distrust") * F.col("distrust")).alias("_d"), F.sum(F.col("_suspicion") * F.col("suspicion")).alias("_s"))
        rank = given.join(seeds, "host", "full").select(
            "host",
            (start("trusted") + F.lit(damping) * F.coalesce("_t", F.lit(0.0))).alias("trust"),
            (start("blocked") + F.lit(damping) * F.coalesce("_d", F.lit(0.0))).alias("distrust"),
            (seed("blocked") + (1 - seed("trusted") - seed("blocked")) * F.lit(damping) * F.coalesce("_s", F.lit(0.0))).alias("suspicion"),
        )
        rank = scratch.table(rank, f"rank{n + 1}")
    return rank


def judge(pages: DataFrame, scratch: Scratch, rules=RULES, suspect: float = SUSPECT) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages``, with the host's two ranks.

    Reads page_id, url and html only. A null url, or one without ``://``, has an empty host and path. Seeds are the shares of
    a host's pages that rules allow and block. A host is bad when its distrust is above its trust and at least
    ``suspect`` times what a wholly blocked host starts with, or its suspicion is at least ``suspect``; pages of all other hosts, known or not, are allowed.
    Repeated rows are judged alike and count in the shares. An empty table gives no rows.
    """
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string").alias("html"))
    parsed = parsed.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    share = lambda action: F.avg(F.when(F.col("_rule.action") == action, 1.0).otherwise(0.0))
    seeds = parsed.where("host != ''").groupBy("host").agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    seeds = scratch.table(seeds, "seeds")
    edges = scratch.table(host_edges(parsed), "edges")
    rank = ranks(edges, seeds, scratch)
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= suspect * (1 - DAMPING)) | (F.col("suspicion") >= suspect)
    hosts = scratch.table(rank.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("_host_verdict")), "hosts")
    hosts = F.broadcast(hosts) if is_small(hosts) else hosts
    return parsed.drop("html").join(hosts, "host", "left").select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.action", "_host_verdict", F.lit("allow")).alias("verdict"), "trust", "distrust",
    )
