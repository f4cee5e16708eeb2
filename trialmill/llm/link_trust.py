"""URL filters with link-graph propagation between hosts, with DataFrame operations only.

Rules name a host and a path. Hosts with pages that a rule judges are seeds, weighted by the majority's lead among
those pages. Trust follows links from allowed seeds (personalised PageRank over host edges), distrust runs against
links from blocked seeds. A page without a rule is blocked if its host's distrust exceeds its trust by the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmill.llm.store import saved

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
DAMPING, ROUNDS, WRITE_EVERY = 0.85, 16, 4
#: Distrust above trust from which a host is blocked; a host with every judged page blocked and no links has 1 - DAMPING.
THRESHOLD = 0.5 * (1 - DAMPING)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. Rules are a short list that goes into the plan."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # the longest comes last and is asked first
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def judged_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and ruled (the rule's verdict)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("ruled"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(a, b, n): links of pages of host a to host b, absolute or with '//', without links of a host to itself."""
    host, _ = host_and_path(F.col("url"))
    link = r"""(?i)\shref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""
    links = pages.select(host.alias("a"), F.explode(F.regexp_extract_all("html", F.lit(link), 1)).alias("link"))
    target, _ = host_and_path(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    links = links.select("a", target.alias("b")).where("a <> '' and b <> '' and a <> b")
    return links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def seeds(ruled: DataFrame) -> DataFrame:
    """Per host with judged pages: trust and distrust, the majority's lead among those pages; one of both is 0."""
    by = ruled.where("host <> '' and ruled is not null").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("good"),
        F.count_if(F.col("ruled") == "block").alias("bad"),
    )
    lead = (F.col("good") - F.col("bad")) / (F.col("good") + F.col("bad"))
    return by.select("host", F.greatest(lead, F.lit(0.0)).alias("trust"), F.greatest(-lead, F.lit(0.0)).alias("distrust"))


def propagated(seed: DataFrame, edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` rounds of both walks, which share one join and one sum a round.

    Trust leaves a host in proportion to its links, distrust in proportion to the links to it. Walks end where
    there is nothing to follow. Lineage is cut in the shared folder every few rounds.
    """
    start = saved(seed, "seeds")
    edges = saved(edges, "edges")
    first = start.select("host", *(((1 - DAMPING) * F.col(c)).alias(c) for c in ("trust", "distrust")))
    if edges.isEmpty():
        return first
    out = edges.groupBy("a").agg(F.sum("n").alias("leaving"))
    into = edges.groupBy("b").agg(F.sum("n").alias("coming"))
    ahead = edges.join(out, "a").select(F.col("a").alias("host"), F.col("b").alias("to"), (F.col("n") / F.col("leaving")).alias("f"), F.lit(0.0).alias("r"))
    back = edges.join(into, "b").select(F.col("b").alias("host"), F.col("a").alias("to"), F.lit(0.0).alias("f"), (F.col("n") / F.col("coming")).alias("r"))
    steps = saved(ahead.unionByName(back), "steps")
    now = first
    for k in range(1, rounds + 1):
        moved = now.join(steps, "host").select(
            F.col("to").alias("host"), (DAMPING * F.col("trust") * F.col("f")).alias("trust"), (DAMPING * F.col("distrust") * F.col("r")).alias("distrust")
        )
        now = moved.unionByName(first).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if k % WRITE_EVERY == 0:
            now = saved(now, "ranks")
    return now


def filtered_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of each row.

    A null url has an empty host and path, no rule, and is allowed; a null html has no links; repeated rows are
    judged each; an empty table gives no rows; other columns are left out.
    """
    ruled = judged_by_rules(pages, rules)
    ranks = propagated(seeds(ruled), host_edges(pages))
    found = ruled.join(ranks, "host", "left").na.fill(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") - F.col("trust") >= THRESHOLD - 1e-12, "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
