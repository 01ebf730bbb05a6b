"""URL filter: allow / block rules, and for hosts that no rule decides,
propagation over the host graph - personalised PageRank from trusted hosts and
reversed distrust from blocked hosts - with a threshold per host.

Host graph: a page's absolute links give edges host -> linked host, and each
host is tied both ways to its parent domain (the host without its first
label, as long as two labels remain), so hosts of one site share their
standing.  Trust walks along the edges from hosts with pages that an allow
rule fits; distrust walks against them from hosts with pages that a block rule
fits, since who links to a blocked host is suspect.  A host is blocked when
its distrust is more than ``bias`` times its trust.

Defined results: a url that is null or has no ``://`` has an empty host and
path, fits no rule and, with no evidence against it, is allowed; null html has
no links; repeated rows are judged alike, each on its own; an empty table
gives no rows.  Other columns are never read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, bounded, spread_join, written

#: (verdict, host, path): the given rules
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits; null if none."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        what = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, what) if out is None else out.when(fits, what)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """Pages (host, html) -> (src, dst, weight)."""
    link = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    found = (pages.where(F.col("html").contains("//")).select(F.col("host").alias("src"), F.explode(link).alias("url")))
    dst, _ = url_parts(F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), F.col("url")))
                       .otherwise(F.col("url")))
    links = (found.select("src", dst.alias("dst")).where("src <> '' and dst <> '' and src <> dst")
             .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")))
    hosts = pages.select("host").where("host <> ''").distinct()
    up = hosts
    ties = None
    # parents of parents too: a host has few labels, the loop ends with the longest name
    while True:
        up = (up.where(F.size(F.split("host", r"\.")) > 2)
              .select("host", F.regexp_replace("host", r"^[^.]*\.", "").alias("parent")))
        up = written(up.distinct(), "host-parents")
        if up.limit(1).count() == 0:
            break
        ties = up if ties is None else ties.unionByName(up)
        up = up.select(F.col("parent").alias("host")).distinct()
    if ties is None:
        return links
    ties = ties.distinct()
    both = (ties.select(F.col("host").alias("src"), F.col("parent").alias("dst"))
            .unionByName(ties.select(F.col("parent").alias("src"), F.col("host").alias("dst"))))
    return (links.unionByName(both.withColumn("weight", F.lit(1.0)))
            .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))


#: hosts in a block of the walk, about
SIZE = 1_000
#: out-edges of a host that one task joins, about
HOT = 100_000


def _blocks(hosts: DataFrame, size: int):
    """Distinct hosts -> a function (rows, host column, name) that adds the
    host's block.  Hosts of one site (the last two labels) share a block, as
    most of their edges run among them; sites are hashed into blocks of about
    ``size`` hosts, and a site of more is split by host.  Those sites are
    fewer than hosts / size."""
    sites = hosts.groupBy(F.substring_index("host", ".", -2).alias("_site")).agg(F.count(F.lit(1)).alias("n"))
    sites = written(sites, "sites")
    total = sites.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    large = written(sites.where(F.col("n") > size).select("_site", F.ceil(F.col("n") / size).alias("_parts")), "large-sites")
    large, count = bounded(large, 64), max(1, -(-total // size))

    def add(rows: DataFrame, host: str, name: str) -> DataFrame:
        part = F.pmod(F.xxhash64(host), F.coalesce("_parts", F.lit(1)))
        return (rows.withColumn("_site", F.substring_index(host, ".", -2)).join(large, "_site", "left")
                .withColumn(name, F.pmod(F.xxhash64("_site", part), F.lit(count))).drop("_site", "_parts"))
    return add


def _settle(damping: float, least: float):
    """A block's edges and the mass that waits at its hosts -> how much passes
    each host before all of it has left the block or restarted."""
    def run(edges: pd.DataFrame, wait: pd.DataFrame) -> pd.DataFrame:
        if not len(wait):
            return wait[["walk", "host", "mass"]]
        ids, hosts = pd.factorize(np.concatenate([c.to_numpy(dtype=object) for c in (wait["host"], edges["src"], edges["dst"])]))
        at, src, dst = np.split(ids, [len(wait), len(wait) + len(edges)])
        p = damping * edges["p"].to_numpy()
        here = np.bincount(at, wait["mass"].to_numpy(), len(hosts))
        passed = here.copy()
        while here.sum() > least:
            here = np.bincount(dst, p * here[src], len(hosts))
            passed += here
        went = passed > 0
        return pd.DataFrame({"walk": wait["walk"].iloc[0], "host": hosts[went], "mass": passed[went]})
    return run


def personalised_ranks(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tol: float = 1e-5,
                       size: int = SIZE) -> DataFrame:
    """Edges (walk, src, dst, weight) and seeds (walk, host, mass, summing to 1
    per walk) -> (walk, host, score): walks that restart at the seeds, all of
    them settled to ``tol`` of their mass.

    A round lets the waiting mass walk inside each block of hosts until it has
    left or restarted (numpy, some ``size`` hosts a task's group), then carries
    what leaves to the blocks of its targets.  What waits after a round is at
    most ``damping`` of what waited before, and a score lacks no more than what
    waits, so stopping below ``tol`` is proven; without edges between blocks
    one round is all.  Edges of a hub are dealt over several tasks, and mass is
    added up on the map side before it is shuffled to a host that everyone
    links to.  Mass at a host without out-edges restarts.
    """
    hosts = edges.select(F.col("src").alias("host")).union(edges.select("dst")).union(seeds.select("host")).distinct()
    block = _blocks(written(hosts, "hosts"), size)
    out = edges.groupBy("walk", "src").agg(F.sum("weight").alias("_all"), F.ceil(F.count(F.lit(1)) / HOT).cast("int").alias("_shares"))
    out = written(out, "out-weights")
    step = spread_join(edges, out, "walk", "src")
    step = step.select("walk", "src", "dst", (F.col("weight") / F.col("_all")).alias("p"),
                       F.pmod(F.xxhash64("dst"), F.col("_shares")).cast("int").alias("share"))
    step = written(block(block(step, "src", "block"), "dst", "to"), "walk")
    inner = step.where("block = to").select("walk", "block", "src", "dst", "p").groupBy("walk", "block")
    cross = step.where("block <> to").select("walk", "src", "share", F.col("to").alias("block"), F.col("dst").alias("host"), "p")
    crossing = cross.limit(1).count() > 0
    hubs = bounded(written(out.where("_shares > 1").select("walk", F.col("src").alias("host"), "_shares"), "hubs"), 64)
    wait = written(block(seeds.select("walk", "host", "mass"), "host", "block"), "waiting")
    settle = _settle(damping, tol / 1_000)
    rounds = []
    while True:
        passed = inner.cogroup(wait.groupBy("walk", "block")).applyInPandas(
            settle, "walk int, host string, mass double")
        passed = written(passed, "passed")
        rounds.append(passed)
        if not crossing:
            break
        dealt = (passed.join(hubs, ["walk", "host"], "left")
                 .select("walk", F.col("host").alias("src"), F.col("mass").alias("m"),
                         F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)).alias("share")))
        wait = written(cross.join(dealt, ["walk", "src", "share"]).groupBy("walk", "block", "host")
                       .agg(F.sum(F.col("m") * F.col("p") * damping).alias("mass")), "waiting")
        if (wait.groupBy("walk").agg(F.sum("mass").alias("m")).agg(F.max("m")).first()[0] or 0.0) < tol:
            break
    return (reduce(DataFrame.unionByName, rounds).groupBy("walk", "host")
            .agg((F.sum("mass") * (1 - damping)).alias("score")))


def personalised_rank(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tol: float = 1e-5,
                      size: int = SIZE) -> DataFrame:
    """One walk: edges (src, dst, weight), seeds (host, mass) -> (host, score)."""
    return personalised_ranks(edges.withColumn("walk", F.lit(0)), seeds.withColumn("walk", F.lit(0)),
                              damping, tol, size).drop("walk")


def _seeds(judged: DataFrame, verdict: str) -> DataFrame:
    n = judged.where(F.col("rv") == verdict).groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    return n.select("host", (F.col("n") / total.scalar()).alias("mass"))


def judge(pages: DataFrame, rules=RULES, damping: float = 0.85, tol: float = 1e-5, bias: float = 1.0) -> DataFrame:
    """Pages (page_id, url, html) -> page_id, host, path, rule, verdict,
    trust, distrust."""
    host, path = url_parts(F.col("url"))
    p = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    p = p.withColumn("_r", rule_for(F.col("host"), F.col("path"), rules)).select(
        "page_id", "html", "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.verdict").alias("rv"))
    judged = written(p.drop("html"), "judged")
    edges = written(host_edges(p.select("host", "html")), "host-edges")
    # both walks go in the same rounds: 0 along the edges, 1 against them
    back = edges.select(F.lit(1).alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    both = written(edges.withColumn("walk", F.lit(0)).unionByName(back), "both-ways")
    seeds = (_seeds(judged, "allow").withColumn("walk", F.lit(0))
             .unionByName(_seeds(judged, "block").withColumn("walk", F.lit(1))))
    ranks = personalised_ranks(both, seeds, damping, tol)
    of = lambda w: F.sum(F.when(F.col("walk") == w, F.col("score")))
    score = written(ranks.groupBy("host").agg(of(0).alias("trust"), of(1).alias("distrust")), "host-scores")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    own = F.when(d > t * bias, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(score, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rv", own).alias("verdict"),
        t.alias("trust"), d.alias("distrust"))
