"""URL filters: host rules, and link-graph trust for what no rule decides.

Rules are (action, ``host/path``): a rule fits its host and all subdomains when
the url's path starts with the rule's path; the longest fitting rule wins.

Urls without a rule take the verdict of their host from the host link graph.
Trust flows from hosts with allowed pages along links, in equal parts over a
host's out-links (personalised PageRank from the trusted).  Distrust flows from
hosts with blocked pages against links: a host takes the mean distrust of the
hosts it links to, which is the personalised PageRank that a walk from this host
gives to the blocked ones.  Both are ``score = seed + damping * flow``; a host's
seed is the share of its pages that the rules allow or block.  The mean is over
a host's own links, so links of other hosts to the same target change nothing:
the threshold means the same in a crawl of any size.  A host is blocked when its
distrust reaches ``threshold`` and exceeds its trust.  Rounds go on until no
score moves by more than ``tolerance`` (relative above one); each round shrinks
what is still under way by ``damping``, so they end.

Links are deduplicated to host edges with map-side combining before any join;
the scores are written to the shared folder each round, so no lineage grows and
a lost executor costs one round.  Joins on a hub host are split by adaptive
execution.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule and is allowed; null html has no links; relative links stay on their
host and add no edge; repeated pages and links count for the share but add no
second edge; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import body, written

#: (action, rule) of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"),
         ("block", "example.com/de/"), ("allow", "org/fr/"))

DAMPING = 0.85
THRESHOLD = 0.5
TOLERANCE = 1e-6

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The target of an absolute or scheme-relative link in raw html.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def compile_rules(rules, host: Column, path: Column) -> Column:
    """The text of the longest fitting rule, or null."""
    chosen = None
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        chosen = F.when(fits, rule) if chosen is None else chosen.when(fits, rule)
    return F.lit(None).cast("string") if chosen is None else chosen


def host_edges(pages: DataFrame, host: Column, html: str) -> DataFrame:
    """Distinct (src, dst) host pairs with the share that each link has of its host's links."""
    links = F.explode(F.array_distinct(F.regexp_extract_all(body(html), F.lit(LINK), F.lit(1))))
    pairs = (pages.select(host.alias("src"), links.alias("dst"))
             .select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
             .where("src <> '' AND src <> dst").distinct())
    pairs = written(pairs, "host-links")
    out = pairs.groupBy("src").agg((1.0 / F.count(F.lit(1))).alias("share"))
    return written(pairs.join(out, "src"), "host-edges")


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """``host, trust, distrust`` from ``seeds`` (same columns) over ``edges``."""
    if not 0.0 <= damping < 1.0:
        raise ValueError("damping must be at least 0 and below 1: the rounds would not end")
    if edges.isEmpty():
        return seeds
    flows = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("from"), F.col("dst").alias("to"),
                 F.col("share").alias("t"), F.lit(0.0).alias("d")),
        F.struct(F.col("dst").alias("from"), F.col("src").alias("to"),
                 F.lit(0.0).alias("t"), F.col("share").alias("d")))).alias("f")).select("f.*")

    def moved(kind: str):
        after, before = F.col(f"a.{kind}"), F.coalesce(f"b.{kind}", F.lit(0.0))
        return F.abs(after - before) / F.greatest(after, F.lit(1.0))

    scores, settled = seeds, False
    while not settled:
        gained = (scores.join(flows, scores["host"] == flows["from"])
                  .groupBy(F.col("to").alias("host"))
                  .agg((damping * F.sum(F.col("trust") * F.col("t"))).alias("trust"),
                       (damping * F.sum(F.col("distrust") * F.col("d"))).alias("distrust")))
        fresh = written(seeds.unionByName(gained).groupBy("host")
                        .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")),
                        "host-scores")
        most = (fresh.alias("a").join(scores.alias("b"), "host", "left")
                .agg(F.max(F.greatest(moved("trust"), moved("distrust")))).first()[0])
        scores, settled = fresh, most is None or most <= tolerance
    return scores


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", damping: float = DAMPING) -> DataFrame:
    """``id_col, host, path, rule, verdict, trust, distrust`` per page."""
    host, path = host_and_path(F.col(url_col))
    action = {rule: act for act, rule in rules}
    parsed = (pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
              .withColumn("rule", compile_rules(rules, F.col("host"), F.col("path"))))
    allowed = [r for r, a in action.items() if a == "allow"]
    by_rule = F.when(F.col("rule").isNull(), None).when(
        F.col("rule").isin(allowed), "allow").otherwise("block")
    ruled = parsed.withColumn("by_rule", by_rule)
    seeds = written(
        ruled.where("host <> ''").groupBy("host")
        .agg((F.count_if(F.col("by_rule") == "allow") / F.count(F.lit(1))).alias("trust"),
             (F.count_if(F.col("by_rule") == "block") / F.count(F.lit(1))).alias("distrust")),
        "host-seeds")
    scores = propagate(host_edges(pages, host, html_col), seeds, damping)
    suspect = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    return (ruled.join(scores, "host", "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("by_rule", F.when(suspect, "block").otherwise("allow"))
                    .alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"),
                    F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
