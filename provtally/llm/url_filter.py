"""URL filters: explicit rules first, then a tree of path templates per host.

A path's segments are generalised by shape (numbers, hex strings), then from the root down segments
that vary too much below their generalised parent become wildcards. The templates' labelled pages
give each a purity, smoothed towards its host and that towards the whole; sibling branches whose
rates do not differ significantly are merged first, from the leaves up. A template whose purity is
too low is blocked.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provtally.llm.common import stored, with_group

#: A parent with more children than this turns those below the share into wildcards.
MANY_CHILDREN, LEAST_SHARE = 8, 0.05
#: Branches differ when their rates are this many standard errors apart.
DIFFERENT = 2.0
#: Labelled pages that the prior of a template and of a host weighs.
TEMPLATE_PRIOR, HOST_PRIOR = 8.0, 20.0
LEAST_PURITY = 0.5
WILD = "*"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class UrlRule(NamedTuple):
    action: str
    host: str
    path: str = "/"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def shape(segment: Column) -> Column:
    """A segment with what is variable by its form replaced."""
    out = F.regexp_replace(segment, "^[0-9]+(?=$|\\.)", "{n}")
    return F.regexp_replace(out, "^(?=[0-9a-f-]*[0-9])[0-9a-f-]{8,}(?=$|\\.)", "{h}")


def _rules_by_host(branches: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """(host, rules) for hosts that rules name or that are below one they name."""
    spark = branches.sparkSession
    table = spark.createDataFrame(
        [(r.host, r.path, f"{r.host}{r.path}", r.action) for r in rules], "_on string, path string, rule string, action string"
    )
    labels = F.split("host", "\\.", -1)
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    hosts = branches.select("host").distinct().select("host", F.explode(above).alias("_on"))
    fits = hosts.join(table, "_on").groupBy("host")
    return fits.agg(F.collect_list(F.struct(F.length("rule").alias("length"), "rule", "path", "action")).alias("rules"))


def _templates(branches: DataFrame) -> DataFrame:
    """branch -> template: level by level, rare children among many below a generalised parent become wildcards.

    A parent of at most MANY_CHILDREN paths can have no wildcard below it, so its paths end with
    their own segments; only the others go a level further.
    """
    rows = branches.select("branch", "host", "n", "shapes", F.lit("").alias("above"))
    done = rows.where(F.size("shapes") == 1).select("branch", F.col("above").alias("template"))
    rows, at = rows.where(F.size("shapes") > 1), 1
    while not rows.isEmpty():
        # The host has no slash and what is above is empty or begins with one.
        parent, segment = F.concat("host", "above"), F.col("shapes")[at]
        rows = rows.withColumn("parent", parent).withColumn("segment", segment)
        rows = rows.withColumn("child", F.concat_ws("/", "parent", "segment"))
        deeper = F.sum((F.size("shapes") > at + 1).cast("long")).alias("deeper")
        children = rows.groupBy("host", "above", "parent", "segment", "child").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("paths"), deeper)
        children = stored(children, "children")
        parents = stored(children.groupBy("parent").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("many")), "parents")
        judged = with_group(children, parents, "parent", "many", F.concat(F.lit("\n"), "child"))
        rare = (F.col("many") > MANY_CHILDREN) & (F.col("n") < LEAST_SHARE * F.col("total"))
        rare = rare & (F.col("segment") != "") & ~F.startswith("segment", F.lit("{"))
        judged = judged.withColumn("next", F.concat_ws("/", "above", F.when(rare, WILD).otherwise(F.col("segment"))))
        judged = stored(judged.select("host", "child", "paths", "deeper", "next"), "judged")
        wide = judged.groupBy("host", "next").agg(F.sum("deeper").alias("below"), F.count(F.lit(1)).alias("members"))
        wide = wide.select(F.concat("host", "next").alias("whole"), (F.col("below") > MANY_CHILDREN).alias("wide"), "members")
        judged = judged.withColumn("whole", F.concat("host", "next"))
        judged = with_group(judged, stored(wide, "wide"), "whole", "members", F.concat(F.lit("\n"), "child"))
        judged = stored(judged.select("child", "paths", "next", "wide"), "judged")
        rows = with_group(rows, judged, "child", "paths", F.concat(F.lit("\n"), "branch"))
        rows = stored(rows.select("branch", "host", "n", "shapes", "next", "wide"), "level")
        at += 1
        on = F.col("wide") & (F.size("shapes") > at)
        rest = F.slice("shapes", F.lit(at + 1), F.greatest(F.size("shapes") - at, F.lit(0)))
        ended = rows.where(~on).select("branch", F.array_join(F.concat(F.array("next"), rest), "/").alias("template"))
        done = done.unionByName(ended)
        rows = rows.where(on).select("branch", "host", "n", "shapes", F.col("next").alias("above"))
    return done


def _pooled(stats: DataFrame, base: float) -> DataFrame:
    """stats with the pool of each template: siblings of like rates are one, level by level from the leaves up.

    Siblings' patterns differ in one segment, literal or wildcard; merged ones have a wildcard there and
    meet the merged ones of their parent's siblings a level further up.
    """
    rows = stats.withColumn("pattern", F.split("template", "/", -1)).withColumn("pool", F.col("template"))
    # Only where paths of one host and length differ can any be siblings.
    places = rows.select("host", F.size("pattern").alias("length"), F.posexplode("pattern").alias("at", "segment"))
    places = places.groupBy("host", "length", "at").agg(F.min("segment").alias("low"), F.max("segment").alias("high"))
    levels = [r["at"] for r in places.where("low <> high").select("at").distinct().collect()]
    for at in sorted(levels, reverse=True):
        literal = (F.size("pattern") > at) & F.get("pattern", F.lit(at)).rlike("^[^{*]")
        starred = F.transform("pattern", lambda x, i: F.when(i == at, F.lit(WILD)).otherwise(x))  # noqa: B023
        groups = rows.groupBy("host", "pattern", "pool").agg(F.sum("seen").alias("seen"), F.sum("good").alias("good"))
        groups = stored(groups.withColumn("family", F.when(literal, starred).otherwise(F.col("pattern"))), "groups")
        whole = groups.groupBy("host", "family").agg(F.sum("seen").alias("all_seen"), F.sum("good").alias("all_good"))
        rate = F.when(F.col("all_seen") > 0, F.col("all_good") / F.col("all_seen")).otherwise(F.lit(base))
        apart = F.abs(F.col("good") - F.col("seen") * rate)
        like = apart <= DIFFERENT * F.sqrt(F.greatest(F.col("seen") * rate * (1 - rate), F.lit(0.0))) + 1e-9
        alike = stored(groups.join(whole, ["host", "family"]).where(like).select("host", "family", "pool"), "siblings")
        merged = alike.groupBy("host", "family").agg(F.min("pool").alias("joint"), F.count(F.lit(1)).alias("many")).where("many > 1")
        moved = alike.join(merged, ["host", "family"]).select("host", "pool", "family", "joint")
        rows = rows.join(moved, ["host", "pool"], "left")
        rows = rows.select(*stats.columns, F.coalesce("family", "pattern").alias("pattern"), F.coalesce("joint", "pool").alias("pool"))
        rows = stored(rows, "pools")
    return rows.drop("pattern")


def _purity(leaves: DataFrame) -> DataFrame:
    """(host, template, purity), after merging siblings of like rates."""
    stats = stored(
        leaves.groupBy("host", "template").agg(F.sum("labelled").alias("seen"), F.sum("good").alias("good")), "templates"
    )
    whole = stats.agg(F.sum("seen").alias("seen"), F.sum("good").alias("good")).first()
    base = (whole["good"] / whole["seen"]) if whole["seen"] else 1.0
    hosts = stats.groupBy("host").agg(F.sum("seen").alias("host_seen"), F.sum("good").alias("host_good"))
    prior = (F.col("host_good") + HOST_PRIOR * base) / (F.col("host_seen") + HOST_PRIOR)
    rows = stored(_pooled(stats, base).select("host", "template", "pool", "seen", "good"), "pooled")
    pools = rows.groupBy("host", "pool").agg(F.sum("seen").alias("m_seen"), F.sum("good").alias("m_good"))
    rows = rows.join(pools, ["host", "pool"]).join(hosts, "host")
    purity = (F.col("m_good") + TEMPLATE_PRIOR * prior) / (F.col("m_seen") + TEMPLATE_PRIOR)
    return rows.select("host", "template", purity.alias("purity"))


def url_verdicts(
    pages: DataFrame, labels: DataFrame, rules: Sequence[UrlRule], id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page row: page_id, host, path, rule, verdict, template, purity.

    ``labels`` has (page_id, good boolean); of repeated labels of a page a good one counts, pages
    without one count as unlabelled. A rule fits its host and all below it when the path starts
    with the rule's; the longest wins, and where none fits the template's purity decides. A url
    that is null or has no ``://`` has empty host and path. With no labels all pages pass. Rules
    are a list held by the caller; they are joined by host. Other columns are not read.
    """
    host, path = parsed(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("shapes", F.transform(F.split("path", "/", -1), shape))
    rows = rows.withColumn("branch", F.concat_ws("/", "host", "shapes")).drop("shapes")
    rows = stored(rows.withColumn("place", F.monotonically_increasing_id()), "pages")
    counts = rows.groupBy("branch", "host").agg(F.count(F.lit(1)).alias("n"))
    once = labels.select(F.col("page_id").alias("_labelled"), F.col("good").cast("int").alias("_good"))
    once = once.where("_labelled is not null and _good is not null").groupBy("_labelled").agg(F.max("_good").alias("_good"))
    marked = rows.join(once, F.col("page_id") == F.col("_labelled")).groupBy("branch", "host")
    marked = marked.agg(F.count(F.lit(1)).alias("labelled"), F.sum("_good").alias("good"))
    branches = counts.join(marked, ["branch", "host"], "left").fillna(0, ["labelled", "good"])
    # The host has no slash, so what follows the first one is the shaped path.
    shaped = F.split(F.substring("branch", F.length("host") + 2, F.length("branch")), "/", -1)
    branches = stored(branches.withColumn("shapes", shaped), "branches")
    leaves = stored(branches.join(_templates(branches), "branch"), "leaves")
    judged = leaves.join(_purity(leaves), ["host", "template"]).join(_rules_by_host(branches, rules), "host", "left")
    judged = stored(judged.select("branch", "n", "template", "purity", "rules"), "judged")
    out = with_group(rows, judged, "branch", "n", F.concat(F.lit("\n"), F.col("place").cast("string")))
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(fitting)
    return out.select(
        "page_id",
        "host",
        "path",
        best["rule"].alias("rule"),
        F.coalesce(best["action"], F.when(F.col("purity") < LEAST_PURITY, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
        "purity",
    )


#: The rules of the query.
QUERY_RULES = (
    UrlRule("block", "net"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def page_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Verdicts of pages whose labels are those of the documents that their urls number."""
    _, path = parsed(F.col("url"))
    numbers = pages.select("page_id", F.regexp_extract(path, "/([0-9]{1,18})(?:/|\\.|$)", 1).try_cast("long").alias("doc_id"))
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    known = numbers.join(labels.select("doc_id", good.alias("good")), "doc_id").select("page_id", "good")
    return url_verdicts(pages, known, QUERY_RULES).drop("template", "purity")
