"""URL filtering by rules, and for other hosts by trust and distrust spread over the graph of hosts.

Trust starts at hosts that rules mostly allow and follows links; distrust starts at hosts that rules mostly
block and goes back along links, to those who link to them. Both are personalised PageRanks, computed
together as joins and sums that do not depend on the order of their rows. The graph's hosts are without user
and port.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.llm.tables import Scratch

# Verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
FOLLOW = 0.85
# Scores are exact to so many binary digits; none that is handed on falls below the least one.
DIGITS, LEAST = 40, 1e-270
# Changes are summed in whole units of which all seeds of a kind have so many.
UNITS = 10**15


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def site(host: Column) -> Column:
    """A host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def fitting(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    found = []
    for verdict, domain, prefix in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        found.append(F.when(fits, F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found)


def host_links(pages: DataFrame) -> DataFrame:
    """Links between unlike hosts: ``source``, ``target``, ``n``, from absolute links in ``html``."""
    links = pages.select(site(F.col("host")).alias("source"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("target"))
    links = links.withColumn("target", site(F.translate("target", UPPER, LOWER)))
    return links.where("source <> '' and target <> '' and source <> target").groupBy("source", "target").agg(F.count("*").alias("n"))


def summed(scores: DataFrame) -> DataFrame:
    """Sums of positive ``score`` by kind and host, the same for any order of rows.

    Scores of one binary order of magnitude are summed as whole numbers, then these sums from the least up.
    """
    power = F.floor(F.log2("score"))
    whole = F.floor(F.col("score") * F.pow(F.lit(2.0), DIGITS - F.col("power"))).cast("decimal(20,0)")
    like = scores.withColumn("power", power).groupBy("kind", "host", "power").agg(F.sum(whole).alias("whole"))
    like = like.select("kind", "host", (F.col("whole").cast("double") * F.pow(F.lit(2.0), F.col("power") - DIGITS)).alias("score"))
    upward = F.aggregate(F.array_sort(F.collect_list("score")), F.lit(0.0), lambda total, score: total + score)
    return like.groupBy("kind", "host").agg(upward.alias("score"))


def own_score(seeds: float) -> float:
    """What each of so many seeds of a kind has without any link."""
    return (1 - FOLLOW) / seeds


def spread(scratch: Scratch, links: DataFrame, seeds: DataFrame, still: float = 1e-6, least: float = 0.0) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` (shares of one), for all hosts that get either.

    ``seeds`` has ``host`` and ``kind``, trust or distrust. A host hands on ``FOLLOW`` of its score by the
    number of links: trust to those it links to, distrust to those that link to it. Every round is written.

    Rounds end when they reach no further host and no more than ``still`` of all scores moves, so every
    host that links lead to has a score above 0. With ``least`` they end when all later rounds together could move
    no more than a tenth of ``least`` of what a seed itself starts with: as each round moves at most ``FOLLOW`` of
    what the one before did, their number grows with the logarithm of the seeds, not with the longest path.
    """
    out = links.groupBy("source").agg(F.sum("n").alias("all"))
    into = links.groupBy("target").agg(F.sum("n").alias("all"))
    forward = links.join(out, "source").select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), (F.col("n") / F.col("all")).alias("share"))
    back = links.join(into, "target").select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"), (F.col("n") / F.col("all")).alias("share"))
    arcs = scratch.put(forward.union(back), "arcs")
    sizes = seeds.groupBy("kind").agg(F.count("*").alias("seeds"))
    start = scratch.put(seeds.join(sizes, "kind").select("kind", "host", (1 / F.col("seeds")).alias("score")), "start")
    base = start.select("kind", "host", (F.col("score") * (1 - FOLLOW)).alias("score"))
    most_seeds = start.agg(F.max(1 / F.col("score"))).first()[0] or 1
    enough = least * own_score(most_seeds) / 10 * (1 - FOLLOW) / FOLLOW
    state = scratch.put(start, "state")
    while True:
        handed = F.greatest(F.col("score") * F.col("share") * FOLLOW, F.lit(LEAST))
        moved = state.join(arcs, ["kind", "host"]).select("kind", F.col("to").alias("host"), handed.alias("score"))
        before, state = state, scratch.put(summed(base.union(moved)), "state")
        # A round keeps all hosts of the one before.
        both = state.select("kind", "host", "score").union(before.select("kind", "host", -F.col("score"))).groupBy("kind", "host")
        each = both.agg(F.floor(F.abs(F.sum("score")) * UNITS).alias("change"), F.count("*").alias("times"))
        change, further = each.agg(F.sum("change"), F.count_if(F.col("times") == 1)).first()
        scratch.keep_only(*scratch.paths)
        if (change or 0) <= (enough if least else still) * UNITS and (least or not further):
            break
    share = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return state.groupBy("host").agg(share("trust"), share("distrust"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, ratio: float = 1.0, least: float = 0.0) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, trust and distrust of the host.

    Columns used: page_id, url, html. A rule decides the pages it fits. A host is a seed of trust if
    rules allow more than half of its pages, of distrust if they block more than half. Other pages
    are blocked if their host's distrust is above 0, at least ``ratio`` times its trust and at least the share
    ``least`` of what a seed of distrust has without any link; else allowed, as are urls without a host. With
    ``least`` 0, one link to a blocked host among any number is enough. Seeds and links are of hosts without user and
    port; ``host`` has both. A null html has no links, a very long one is searched whole. Repeated rows count as
    often as they occur. An empty table gives an empty one.
    """
    scratch = Scratch(pages.sparkSession, "linkgraph")
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    ruled = scratch.put(parts.select("page_id", "host", "path", fitting(F.col("host"), F.col("path"), rules).alias("fit")), "ruled")
    links = scratch.put(host_links(parts), "links")
    hosts = ruled.select(site(F.col("host")).alias("host"), "fit").where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("fit.verdict") == "allow").alias("allowed"), F.count_if(F.col("fit.verdict") == "block").alias("blocked")
    )
    kind = F.when(2 * F.col("allowed") > F.col("pages"), F.lit("trust")).when(2 * F.col("blocked") > F.col("pages"), F.lit("distrust"))
    seeds = scratch.put(hosts.select("host", kind.alias("kind")).where("kind is not null"), "seeds")
    floor = least * own_score(max(1, seeds.where("kind = 'distrust'").count()))
    scores = scratch.put(spread(scratch, links, seeds, least=least), "scores")
    scratch.keep_only("ruled", "scores")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_graph = F.when((distrust > 0) & (distrust >= floor) & (distrust >= ratio * trust), F.lit("block")).otherwise(F.lit("allow"))
    scores = scores.withColumnRenamed("host", "site")
    return ruled.join(scores, site(F.col("host")) == F.col("site"), "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", by_graph).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
