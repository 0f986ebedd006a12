"""URL filters: prefix rules, and scores that travel over links between hosts.

A page that a rule covers takes the rule's verdict.  For the others the hosts are scored: trust
is a personalised PageRank that starts from hosts with allowed pages and follows links; distrust
starts from hosts with blocked pages and follows links backwards, since a page vouches for what it
links to.  Hosts are also linked with their parent domain both ways.  A host whose distrust exceeds its
trust by more than a threshold, in multiples of the mean score, is blocked.  DataFrame functions only.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelanes.session import stored

#: Absolute and protocol-relative link targets; relative links stay on their host and add no edge.
LINK = r"""(?i:href|src)\s*=\s*["']?(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""
DAMPING, THRESHOLD = 0.85, 1.0
TOLERANCE = 1e-4  # change of any host, in multiples of the mean score, at which the scores stand
_CUT = 6  # rounds between written tables


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def parents(host: Column) -> Column:
    """The host and every domain above it, longest first."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct host the rules on it or a domain above, longest first.

    ``rules`` has rule (host and path prefix, like ``net/es/``) and verdict."""
    split = rules.select(F.substring_index("rule", "/", 1).alias("domain"),
                         F.struct(F.length("rule").alias("size"), "rule", F.expr("substr(rule, instr(rule, '/'))").alias("prefix"), "verdict").alias("of"))
    near = hosts.select("host", F.explode(parents(F.col("host"))).alias("domain")).join(split, "domain")
    return near.groupBy("host").agg(F.sort_array(F.collect_list("of"), asc=False).alias("rules"))


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between different hosts (src, dst, n) from rows (host, html), with both ways between a host and its parent."""
    links = (pages.where("host <> '' and html is not null")
             .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
             .select("src", lower_ascii(F.col("to")).alias("dst")).where("src <> dst")
             .groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n")))
    hosts = pages.select("host").union(links.select("dst")).where("host <> ''").distinct()
    up = (hosts.select(parents(F.col("host")).alias("p"))
          .where(F.size("p") > 2)
          .select(F.explode(F.expr("transform(sequence(0, size(p) - 3), i -> struct(p[i] as src, p[i + 1] as dst))")).alias("e"))
          .select("e.*").distinct())
    tree = up.union(up.select("dst", "src")).select("src", "dst", F.lit(1.0).alias("n"))
    return links.unionByName(tree).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def scores(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of trust (along edges) and distrust (against them).

    ``seeds`` has host, trust, distrust (weights from 0 on).  Every host keeps a share of its score by a
    link to itself, so no score is lost at hosts without links.  Returns host, trust, distrust as multiples of
    the mean over hosts.

    There are as many rounds as it takes, however long the ways from the seeds are: until no host's score has changed by more
    than ``tolerance`` over _CUT rounds.  One number a check reaches the driver, and every check ends in a written table."""
    hosts = seeds.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    loops = hosts.select(F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(1.0).alias("n"))
    ways = (edges.unionByName(loops).select(F.lit("trust").alias("kind"), "src", "dst", "n")
            .unionByName(edges.unionByName(loops).select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")))
    out = ways.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    ways = stored(ways.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("all")).alias("share")), "ways")
    start = hosts.join(seeds, "host", "left").select("host", F.explode(F.create_map(
        F.lit("trust"), F.coalesce("trust", F.lit(0.0)), F.lit("distrust"), F.coalesce("distrust", F.lit(0.0)))).alias("kind", "weight"))
    totals = start.groupBy("kind").agg(F.sum("weight").alias("total"), F.count(F.lit(1)).alias("n"))  # two rows
    start = stored(start.join(F.broadcast(totals), "kind").select("kind", "host", "n", F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(0.0).alias("seed")), "seeds")
    def step(rank: DataFrame) -> DataFrame:
        sent = (rank.withColumnRenamed("host", "src").join(ways, ["kind", "src"])
                .select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("share")).alias("part"))
                .groupBy("kind", "host").agg(F.sum("part").alias("got")))
        return (start.join(sent, ["kind", "host"], "left")
                .select("kind", "host", "n", ((1 - damping) * F.col("seed") + damping * F.coalesce("got", F.lit(0.0))).alias("score")))

    rank = start.select("kind", "host", "n", F.col("seed").alias("score"))
    while True:
        new = rank
        for _ in range(_CUT):
            new = step(new)
        new = stored(new, "rank")
        moved = (new.join(rank.select("kind", "host", F.col("score").alias("before")), ["kind", "host"])
                 .agg(F.max(F.abs(F.col("score") - F.col("before")) * F.col("n"))).first()[0])
        rank = new
        if moved is None or moved <= tolerance:
            break
    value = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score") * F.col("n"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(value("trust"), value("distrust"))


def judge(pages: DataFrame, rules: DataFrame, threshold: float = THRESHOLD, damping: float = DAMPING, tolerance: float = TOLERANCE,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each page, repeats included: page_id, host, path, rule, verdict, trust, distrust.

    Urls and html of any length are read whole.  A null url, or one without ``://``, has an empty host and path; such pages no rule can cover and hosts
    without any score are allowed.  Null html has no links; null ids stay null; other columns are not read."""
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), F.col(html_col).alias("html"))
    sent = rows.drop("html")
    counted = sent.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    of = stored(rules_by_host(sent.select("host").distinct(), rules), "host_rules")

    def ruled(frame: DataFrame) -> DataFrame:
        # null where no rule of the host fits the path
        hit = F.try_element_at(F.filter("rules", lambda r: F.startswith(F.col("path"), r["prefix"])), F.lit(1))
        return frame.join(of, "host", "left").withColumn("hit", hit).drop("rules")

    share = lambda verdict: (F.sum(F.when(F.col("hit.verdict") == verdict, F.col("pages")).otherwise(0)) / F.sum("pages"))
    seeds = stored(ruled(counted).where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "host_seeds")
    edges = stored(host_edges(rows.select("host", "html")), "host_edges")
    scored = scores(edges, seeds, damping, tolerance)
    out = ruled(sent).join(scored, "host", "left")
    blocked = F.round(F.col("distrust") - F.col("trust"), 9) > threshold
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                      F.coalesce("hit.verdict", F.when(blocked, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


def as_rules(spark, allow: Iterable[str] = (), block: Iterable[str] = ()) -> DataFrame:
    rows = [(r, "allow") for r in allow] + [(r, "block") for r in block]
    listed = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(v).alias("verdict")) for r, v in rows])
    return spark.range(1).select(F.inline(listed))
