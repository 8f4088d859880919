"""URL verdicts: host and path rules, then link-graph propagation.

A rule names a host (and all its subdomains) and a path prefix; the longest
rule that fits decides. Pages without a rule take the verdict of their host.
Trust flows from the hosts that rules allow along links (personalised
PageRank: a host's trust is shared by the hosts it links to). Distrust flows
from the hosts that rules block against the links, as the mean over a host's
own links: it tells how much of what a host links to leads to blocked hosts,
however many others link there too. A host with one bad link among ten
thousand gets next to none, one whose only link is bad gets nearly all.

A host is blocked when its distrust exceeds its trust and is at least
``LEAST``: the share ``BAD_SHARE`` of what a host gets whose links all lead to
wholly blocked hosts. Ranks are passed on until none changes by more than a
hundredth of that (they grow from below, by a factor of 0.85 a step, so the
number of rounds is bounded whatever the graph).

Links are the absolute and protocol-relative href addresses of a page; each
host counts once per linked host. Ranks are integers (parts of ``UNIT``), so
sums are exact and the verdicts do not depend on the order of the rows.

Everything runs in built-in functions and joins. Edge cases: a null url or one
without ``://`` has an empty host and path; pages without html have no links;
hosts without any link or rule are allowed; repeated rows are judged each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.staging import staged

#: (verdict, host, path prefix)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UNIT = 1_000_000_000
DAMPING_PERCENT = 85
#: Share of a host's links that must lead to wholly blocked hosts.
BAD_SHARE = 0.05
LEAST = int(BAD_SHARE * UNIT * DAMPING_PERCENT * (100 - DAMPING_PERCENT) / 10_000)
SETTLED = LEAST // 100
LINK = r"""(?i)href\s*=\s*["']?((?:https?:)?//[^"'\s>]++)"""


def host_of(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(host_of(rest), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict); null where none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def links(pages: DataFrame) -> DataFrame:
    """Distinct (source, target) hosts of the links between different hosts."""
    urls = F.regexp_extract_all(F.col("_html"), F.lit(LINK), F.lit(1))
    target = host_of(F.regexp_replace(F.col("_url"), r"^(?i:https?:)?//", ""))
    edges = pages.select(F.col("host").alias("source"), F.explode(urls).alias("_url")).select("source", target.alias("target"))
    return edges.where((F.col("source") != "") & (F.col("target") != "") & (F.col("source") != F.col("target"))).distinct()


def propagate(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) over edges."""
    out = edges.groupBy("source").agg(F.count("*").alias("_out"))
    weighted = staged(edges.join(out, "source"), "edges")
    damped = [F.floor(F.col(c) * (100 - DAMPING_PERCENT) / 100).cast("long").alias(c) for c in ("trust", "distrust")]
    own = seeds.select("host", *damped)
    if weighted.isEmpty():
        return own
    nothing = F.lit(0).cast("long")
    passed = lambda c: F.floor(F.col(c) * DAMPING_PERCENT / 100 / F.col("_out")).cast("long")
    ranks = own
    while True:
        forward = weighted.join(ranks, weighted["source"] == ranks["host"]).where("trust > 0")
        forward = forward.select(F.col("target").alias("host"), passed("trust").alias("trust"), nothing.alias("distrust"))
        back = weighted.join(ranks, weighted["target"] == ranks["host"]).where("distrust > 0")
        back = back.select(F.col("source").alias("host"), nothing.alias("trust"), passed("distrust").alias("distrust"))
        every = forward.unionByName(back).unionByName(own).withColumn("before", F.struct(nothing.alias("t"), nothing.alias("d")))
        last = ranks.select("host", nothing.alias("trust"), nothing.alias("distrust"), F.struct(F.col("trust").alias("t"), F.col("distrust").alias("d")).alias("before"))
        sums = [F.sum(c).alias(c) for c in ("trust", "distrust")]
        steps = [F.sum(f"before.{c}").alias(f"_{c}") for c in "td"]
        step = staged(every.unionByName(last).groupBy("host").agg(*sums, *steps), "ranks")
        ranks = step.select("host", "trust", "distrust")
        if step.where((F.col("trust") - F.col("_t") > SETTLED) | (F.col("distrust") - F.col("_d") > SETTLED)).isEmpty():
            return ranks


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust."""
    host, path = parsed(F.col("url").cast("string"))
    df = pages.select(F.col("page_id").alias("page_id"), host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("_html"))
    df = df.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    share = lambda v: F.floor(F.count(F.when(F.col("_rule.verdict") == v, 1)) * UNIT / F.count("*")).cast("long")
    seeds = staged(df.where("host != ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust")), "seeds")
    ranks = propagate(seeds, staged(links(df), "links"))
    hosts = ranks.withColumnRenamed("host", "_host")
    blocked = (F.col("distrust") >= LEAST) & (F.col("distrust") > F.col("trust"))
    own = F.when(blocked, "block").otherwise("allow")
    out = df.drop("_html").join(hosts, F.col("host") == F.col("_host"), "left")
    return out.select(
        "page_id", "host", "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )
