"""URL filters by propagation over the link graph, in DataFrame functions alone.

A rule names a host and the start of a path; it fits the host and its subdomains,
and the longest fitting rule decides. Pages that no rule fits are judged by host.
Trust starts on hosts in proportion to their pages that rules allow and follows
the links (personalised PageRank); distrust starts in proportion to their pages
that rules block and runs against the links, from a blocked host to those that
link to it. Both are iterated until they stand still and are shares of all there is, so what
hosts without links lose counts as given back to the seeds. A host is blocked if distrust is
more than ``THRESHOLD`` of its trust and distrust together, and at least ``EVIDENCE`` times its
share of pages: a trace of distrust that reaches a large host over many links decides nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulemill.llm.common import stored

DAMPING = 0.85
TOLERANCE = 1e-4  # change of all ranks of a kind in the steps between two writes at which they stand still
THRESHOLD = 0.5
EVIDENCE = 0.25
CUT_EVERY = 8  # steps after which the ranks are written
DOMAIN_LINKS = 1.0  # weight, in links, of the edges between a host and the domain above it
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>\\]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for a null one and one without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def parent_domains(host: Column) -> Column:
    """A host and the domains above it, the longest first."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def read_rules(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(action, host, path) as a table."""
    return spark.createDataFrame([(a, h.lower(), p) for a, h, p in rules], "action string, rule_host string, rule_path string")


def pages_of(pages: DataFrame, key: str, url: str, html: str | None) -> DataFrame:
    host, path = url_parts(F.col(f"`{url}`").cast("string"))
    links = F.regexp_extract_all(F.col(f"`{html}`").cast("string"), F.lit(LINK), 1) if html else F.array().cast("array<string>")
    return pages.select(F.col(f"`{key}`").alias("page"), host.alias("host"), path.alias("path"), links.alias("links"))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules whose host is that host or above it; at most all rules."""
    wide = hosts.select("host", F.explode(parent_domains(F.col("host"))).alias("rule_host"))
    each = F.struct((F.length("rule_host") + F.length("rule_path")).alias("size"), (F.col("action") == "block").cast("int").alias("first"),
                    "rule_path", F.concat("rule_host", "rule_path").alias("rule"), "action")
    return wide.join(rules, "rule_host").groupBy("host").agg(F.sort_array(F.collect_set(each), asc=False).alias("rules"))


def decide(path: Column, rules: Column) -> Column:
    """The longest rule that fits a path; of two as long, the blocking one."""
    return F.get(F.filter(rules, lambda r: F.startswith(path, r["rule_path"])), F.lit(0))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between hosts, counted, and the edges to the domain above."""
    near = lower_ascii(F.regexp_replace("link", r"^[^@]*@", ""))
    links = (pages.where("size(links) > 0 AND host != ''").select("host", F.explode("links").alias("link")).select(F.col("host").alias("src"), near.alias("dst"))
             .where("dst != '' AND src != dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("n")))
    hosts = pages.where("host != ''").select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    above = parent_domains(F.col("host"))
    up = hosts.select(F.explode(F.slice(above, 1, F.greatest(F.size(above) - 2, F.lit(0)))).alias("src")).distinct()
    up = up.select("src", F.regexp_replace("src", r"^[^.]*\.", "").alias("dst")).where("dst != ''")
    down = up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    domain = up.unionByName(down).withColumn("n", F.lit(DOMAIN_LINKS))
    return links.unionByName(domain).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def walks(edges: DataFrame) -> DataFrame:
    """(kind, src, dst, w): steps of trust along the edges and of distrust against
    them; what leaves a host adds up to 1."""
    both = edges.withColumn("kind", F.lit("trust")).unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit("distrust").alias("kind")))
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    return both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("w"))


def propagate(steps: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of each kind: (kind, host, v) from seeds (kind, host, s).

    A step shrinks the error by ``damping``, so the number of steps is bounded by the
    tolerance, whatever the graph."""
    again = seeds.select("kind", "host", ((1 - damping) * F.col("s")).alias("v"))
    ranks = seeds.select("kind", "host", F.col("s").alias("v"))
    while True:
        before = ranks
        for _ in range(CUT_EVERY):
            moved = ranks.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (damping * F.col("v") * F.col("w")).alias("v"))
            ranks = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("v").alias("v"))
        ranks = stored(ranks, "url-ranks")
        change = ranks.unionByName(before.withColumn("v", -F.col("v"))).groupBy("kind", "host").agg(F.abs(F.sum("v")).alias("v"))
        if (change.agg(F.sum("v")).first()[0] or 0.0) <= tolerance:
            return ranks


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", html: str | None = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page.

    ``rule`` is the deciding rule's text, else null. A null URL or one without
    ``://`` has an empty host and path, stands outside the graph and is allowed. A
    null or empty ``html`` has no links; repeated rows are judged alike and their
    links count each; an empty rule table leaves every host allowed, an empty page
    table gives no rows. Other columns are dropped, so none can clash.
    """
    whole = stored(pages_of(pages, key, url, html), "url-pages")
    hosts = whole.groupBy("host").agg(F.count("*").alias("pages"))
    known = host_rules(hosts.where("host != ''"), rules)
    hosts = stored(hosts.join(known, "host", "left"), "url-hosts")
    ruled = whole.join(hosts.select("host", "rules"), "host", "left").withColumn("fit", decide(F.col("path"), F.col("rules")))
    marked = ruled.where("fit IS NOT NULL").groupBy("host", F.col("fit.action").alias("action")).agg(F.count("*").cast("double").alias("n"))
    marked = stored(marked.select(F.when(F.col("action") == "allow", "trust").otherwise("distrust").alias("kind"), "host", "n"), "url-marked")
    totals = marked.groupBy("kind").agg(F.sum("n").alias("total"))
    seeds = marked.join(totals, "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("s"))
    ranks = propagate(stored(walks(host_edges(whole)), "url-walks"), stored(seeds, "url-seeds"))
    value = {k: F.sum(F.when(F.col("kind") == k, F.col("v"))).alias(k) for k in ("trust", "distrust")}
    totals = ranks.groupBy("kind").agg(F.sum("v").alias("total"))
    ranks = ranks.join(totals, "kind").select("kind", "host", (F.col("v") / F.col("total")).alias("v"))
    scores = ranks.groupBy("host").agg(*value.values())
    n_pages = whole.count()
    judged = hosts.join(scores, "host", "left").select(
        "host", "rules", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        (F.col("pages") / max(n_pages, 1)).alias("share"))
    bad = (F.col("host") != "") & (F.col("distrust") > THRESHOLD * (F.col("trust") + F.col("distrust"))) & (F.col("distrust") >= EVIDENCE * F.col("share"))
    judged = stored(judged.select("host", "rules", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("method")), "url-judged")
    out = whole.join(judged, "host", "left").withColumn("fit", decide(F.col("path"), F.col("rules")))
    return out.select(F.col("page").alias("page_id"), "host", "path", F.col("fit.rule").alias("rule"),
                      F.coalesce("fit.action", "method").alias("verdict"), "trust", "distrust")
