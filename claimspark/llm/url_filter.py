"""URL filters from rules and from a tree of path templates.

Rules decide the urls they fit. The others are judged by the templates of their host: the rules' decisions are the labels,
and a template is rejected if its smoothed share of blocked pages is too high.

The tree is grown branching by branching over the distinct typed paths of each host (segments with digits or long hex are
replaced by their type at once, so there are far fewer than pages); what all paths of a node have in common is taken in one
step, so paths may be of any depth. At a node, literal children become one wildcard if they are many and each is rare; the
rest are merged with those siblings from whose pooled rate of blocked pages they do not differ significantly. A node is
compared with the pool, never with each sibling.

Labels are pooled where a host has none. A child without labels is compared by those that its name has at this depth on all
hosts. These counts also make the prior of each path: from name to name it moves towards the rate that pages with this name
at this depth have. A template's own labels are smoothed towards the prior of its paths, so that a template without labels is
rejected if pages under the same names are blocked on other hosts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm.common import written

MANY_CHILDREN = 16
RARE_VISITS = 4.0
#: A rate further than this many standard errors from the siblings' pooled rate is different.
SIGNIFICANT = 2.0
PRIOR_RATE = 0.25
PRIOR_WEIGHT = 4.0
REJECT_RATE = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("allow", "com/"),
    Rule("block", "example.com/en/"),
    Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"),
    Rule("block", "net/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path without query and fragment; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def by_rules(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; NULL if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # a longer one replaces a shorter one
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def typed(path: Column) -> Column:
    """Segments of a path, those with digits or long hex by type."""

    def one(s: Column) -> Column:
        stem = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
        ending = F.substring(s, F.length(stem) + 1, F.length(s))
        kind = (
            F.when(stem.rlike(r"^\d+$"), "{n}")
            .when(stem.rlike(r"^\d{4}-\d{2}(-\d{2})?$"), "{date}")
            .when(stem.rlike(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), "{uuid}")
            .when(stem.rlike(r"(?i)^(?=.*\d)[0-9a-f]{8,}$"), "{hex}")
            .when(stem.rlike(r"\d"), F.regexp_replace(stem, r"\d+", "{n}"))
            .otherwise(stem)
        )
        return F.concat(kind, ending)

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), one)


def smoothed(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + PRIOR_WEIGHT * prior) / (labelled + PRIOR_WEIGHT)


def _common_taken(rows: DataFrame) -> DataFrame:
    """Each node goes down by the segments that all its paths have in common."""
    rest = F.slice("parts", F.col("depth") + 1, F.size("parts"))
    ends = rows.groupBy("host", "node").agg(F.min(rest).alias("low"), F.max(rest).alias("high"))
    apart = F.array_position(F.zip_with("low", "high", lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    ends = ends.select("host", "node", F.when(apart == 0, F.size("low")).otherwise(apart - 1).cast("int").alias("common"))
    down = rows.join(ends.where("common > 0"), ["host", "node"], "left").withColumn("common", F.coalesce("common", F.lit(0)))
    taken = F.concat(F.lit("/"), F.array_join(F.slice("parts", F.col("depth") + 1, F.col("common")), "/"))
    return down.withColumns({"node": F.when(F.col("common") > 0, F.concat("node", taken)).otherwise(F.col("node")), "depth": F.col("depth") + F.col("common")}).drop("common")


def _names(paths: DataFrame) -> DataFrame:
    """Rows (at, name, all_labelled, all_blocked): the labels of each literal segment at its depth on all hosts."""
    each = paths.select("labelled", "blocked", F.posexplode("parts").alias("at", "name")).where(~F.col("name").contains("{"))
    return each.groupBy("at", "name").agg(F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"))


def _with_prior(paths: DataFrame, names: DataFrame) -> DataFrame:
    """The rate that the names on each path lead to, one after the other, from ``PRIOR_RATE`` on."""
    each = paths.select("host", "parts", F.posexplode("parts").alias("at", "name")).join(names, ["at", "name"])
    held = each.groupBy("host", "parts").agg(F.array_sort(F.collect_list(F.struct("at", "all_labelled", "all_blocked"))).alias("held"))
    rate = F.aggregate(F.coalesce("held", F.array().cast("array<struct<at:int,all_labelled:long,all_blocked:long>>")), F.lit(PRIOR_RATE), lambda p, x: smoothed(x["all_blocked"], x["all_labelled"], p))
    return paths.join(held, ["host", "parts"], "left").withColumn("prior", rate).drop("held")


def _branched(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Each node gives its children, like ones as one, and the rows go down to them."""
    rows = rows.withColumn("child", F.get("parts", F.col("depth")))
    children = rows.where(F.col("child").isNotNull()).groupBy("host", "node", "child", "depth").agg(*(F.sum(c).alias(c) for c in ("visits", "labelled", "blocked")))
    children = written(children.withColumn("literal", ~F.col("child").contains("{")), "children")
    named = (F.col("child") == F.col("name")) & (F.col("depth") == F.col("at"))
    children = children.join(names, named, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("all_labelled", "all_blocked")})
    nodes = children.groupBy("host", "node").agg(
        F.count_if("literal").alias("literals"),
        F.sum(F.when(F.col("literal"), F.col("visits")).otherwise(0)).alias("literal_visits"),
        (F.sum("blocked") / F.greatest(F.sum("labelled"), F.lit(1))).alias("pool"),
        (F.sum("all_blocked") / F.greatest(F.sum("all_labelled"), F.lit(1))).alias("all_pool"),
    )
    many = (F.col("literals") >= MANY_CHILDREN) & (F.col("literal_visits") < RARE_VISITS * F.col("literals"))
    own = F.col("labelled") > 0
    n, k, pool = (F.when(own, F.col(c)).otherwise(F.col(f"all_{c}")) for c in ("labelled", "blocked", "pool"))
    error = F.sqrt(F.greatest(pool * (1 - pool), F.lit(0.01)) / F.nullif(n, F.lit(0)))
    apart = (k / F.nullif(n, F.lit(0)) - pool) / error
    like = (
        F.when(n == 0, "{unlabelled}")
        .when(F.abs(apart) <= SIGNIFICANT, F.when(own, "{pooled}").otherwise("{pooled elsewhere}"))
        .when(apart > 0, F.concat(F.lit("{worse:"), "child", F.lit("}")))
        .otherwise(F.concat(F.lit("{better:"), "child", F.lit("}")))
    )
    step = F.when(~F.col("literal"), F.col("child")).when(many, "{*}").otherwise(like)
    steps = children.join(nodes, ["host", "node"]).select("host", "node", "child", step.alias("step"))
    went = F.col("step").isNotNull()
    down = rows.join(steps, ["host", "node", "child"], "left")
    node = F.when(went, F.concat("node", F.lit("/"), "step")).otherwise(F.col("node"))
    return down.withColumns({"node": node, "depth": F.col("depth") + went.cast("int")}).drop("step", "child")


def templates(paths: DataFrame) -> DataFrame:
    """Rows (host, parts, template, labelled, blocked, prior) for rows (host, parts, visits, labelled, blocked), one for each typed path."""
    paths = written(paths, "paths")
    names = written(_names(paths), "names")
    rows = written(_with_prior(paths, names).withColumns({"node": F.lit(""), "depth": F.lit(0)}), "paths")
    while rows.where(F.size("parts") > F.col("depth")).limit(1).count():
        taken = written(_common_taken(rows), "paths")
        rows = written(_branched(taken, names), "paths")
    prior = F.sum(F.col("prior") * F.col("visits")) / F.sum("visits")
    per = rows.groupBy("host", "node").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), prior.alias("prior"))
    return rows.select("host", "parts", "node").join(per, ["host", "node"]).withColumnRenamed("node", "template")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, template, blocked_rate): one for each page.

    The verdict is the longest rule's that fits (among equals the last in order), else it is ``block`` if the template's
    smoothed share of blocked pages reaches ``REJECT_RATE``, else ``allow``; without labels on any host it is the prior rate.
    A NULL url, or one without ``://``, has an empty host and path and is judged like any other. Ids may be NULL; repeated
    rows count as often as they are given. Other columns are left aside. An empty table gives no rows.
    """
    host, path = host_and_path(pages[url_col])
    rows = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    rows = written(rows.withColumns({"rule": rule, "ruled": verdict}).withColumn("parts", typed(F.col("path"))), "urls")
    is_labelled = F.col("ruled").isNotNull()
    paths = rows.groupBy("host", "parts").agg(
        F.count("*").alias("visits"), F.count_if(is_labelled).alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    found = written(templates(paths), "templates")
    rate = smoothed(F.col("blocked"), F.col("labelled"), F.col("prior"))
    return rows.join(found, ["host", "parts"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(rate >= REJECT_RATE, "block").otherwise("allow")).alias("verdict"),
        "template",
        rate.alias("blocked_rate"),
    )
