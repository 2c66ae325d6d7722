"""Operator 6, URL filters: a path-template tree per host with smoothed labelled purity.

Paths become lists of segments. Going down from the host, a segment becomes a wildcard if
it looks variable (digits, long codes) or if its level under one parent has nearly as many
different values as paths and it has itself fewer than MIN_PATHS of them. The siblings that
are left are ordered by their share of blocked pages and divided at the cut that sets the two
sides furthest apart (a z-test of two shares), each side once more, as long as the test reaches
MIN_Z; siblings on one side are merged into a wildcard of their own, a single one keeps its
name. Siblings without a labelled page are kept apart from all of these, in a wildcard that no
label speaks for. What is left are templates; a template is rejected if it holds labelled pages
and its blocked share, smoothed towards its host's, which is smoothed towards that of all
pages, reaches LIMIT. All segments are looked at. Where the labelled pages below a branch are
all blocked or all not, no test can set a part of them apart: what is left of these paths are
wildcards, and they leave the loop.

Labels are the verdicts of the given allow and block rules unless a table (page_id, blocked)
is given. A page that a rule decides keeps the rule's verdict; all others get that of their
template. Null urls and urls without ``://`` have an empty host and path and are judged as
such pages together. Repeated pages count as often as they occur. Counts per host and path
come first, so a host with a third of all pages only widens them; the ordered shares of one
level are as many as its siblings have different shares, far fewer than the siblings. Other
columns of the tables are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnline.llm.common import ascii_lower, table, written

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Numbers, three digits in a row, and long codes. Names such as mp3 are none.
VARIABLE = r"^[0-9]+$|[0-9]{3,}|^[0-9a-f-]{16,}$|^.{40,}$"
ANY = "*"
#: A sibling without labelled pages.
UNSEEN = "?"
MIN_PATHS = 8
MAX_DISTINCT = 0.5
MIN_Z = 3.0
DIVISIONS = 2
WEIGHT = 4.0
LIMIT = 0.5

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last that fits wins, so the longest comes last; block wins a tie.
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, named).otherwise(chosen)
    return chosen


def _share(blocked: Column, labelled: Column, towards: Column) -> Column:
    return (blocked + WEIGHT * towards) / (labelled + WEIGHT)


def divided(shares: DataFrame) -> DataFrame:
    """``shares`` (host, template, part, share, labelled, blocked) with parts cut in two where the z-test allows it.

    The cut is the one with the greatest z of all between two neighbouring shares; the upper
    side of part p becomes part 2p + 1, what stays together or below it 2p.
    """
    part = ["host", "template", "part"]
    below = Window.partitionBy(*part).orderBy("share").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*part)
    sums = shares.withColumn("l", F.sum("labelled").over(below)).withColumn("b", F.sum("blocked").over(below))
    sums = sums.withColumn("l_all", F.sum("labelled").over(whole)).withColumn("b_all", F.sum("blocked").over(whole))
    rest, usual = F.col("l_all") - F.col("l"), F.col("b_all") / F.col("l_all")
    apart = (F.col("b_all") - F.col("b")) / rest - F.col("b") / F.col("l")
    z = F.when(rest > 0, apart / F.sqrt(usual * (1 - usual) * (1 / F.col("l") + 1 / rest)))
    cut = F.max(F.struct(F.col("z"), F.col("share"))).over(whole)
    tested = sums.withColumn("z", z).withColumn("cut", cut)
    upper = (F.col("cut.z") >= MIN_Z) & (F.col("share") > F.col("cut.share"))
    return tested.select("host", "template", (F.col("part") * 2 + F.coalesce(upper, F.lit(False)).cast("int")).alias("part"), "share", "labelled", "blocked", "siblings")


def steps(level: DataFrame) -> DataFrame:
    """(host, template, branch, step): what stands in the template for each sibling of a level."""
    share = F.col("blocked") / F.col("labelled")
    seen = level.where("labelled > 0").withColumn("share", share)
    shares = seen.groupBy("host", "template", "share").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.count("*").alias("siblings"))
    shares = shares.withColumn("part", F.lit(0))
    for _ in range(DIVISIONS):
        shares = divided(shares)
    side = Window.partitionBy("host", "template", "part")
    lowest = F.min("part").over(Window.partitionBy("host", "template"))
    highest = F.max("part").over(Window.partitionBy("host", "template"))
    # Undivided siblings are one wildcard, also a single one.
    alone = (F.sum("siblings").over(side) == 1) & (lowest < highest)
    named = F.when(F.col("part") == lowest, F.lit(ANY)).otherwise(F.concat(F.lit(ANY), F.col("part").cast("string")))
    shares = shares.withColumn("wild", F.when(~alone, named)).select("host", "template", "share", "wild")
    found = seen.join(shares, ["host", "template", "share"]).select("host", "template", "branch", F.coalesce("wild", "branch").alias("step"))
    return found.unionByName(level.where("labelled = 0").select("host", "template", "branch", F.lit(UNSEEN).alias("step")))


def path_templates(paths: DataFrame) -> DataFrame:
    """(host, path, template) for distinct (host, path, n, labelled, blocked)."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = paths.withColumn("segments", segments).withColumn("template", F.lit(""))
    ended = []
    for depth in count():
        own = F.get("segments", F.lit(depth))
        literal = F.when(own.rlike(VARIABLE), F.lit(ANY)).otherwise(own)
        rows = written(rows.withColumn("branch", literal), "branches")
        ended.append(rows.where("branch is null").select("host", "path", "template", "n", "labelled", "blocked"))
        rows = rows.where("branch is not null")
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, ended)
        values = rows.groupBy("host", "template", "branch").agg(
            F.count("*").alias("paths"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
        )
        # Folded and joined: a window would bring all branches of a host into one task.
        parent = values.groupBy("host", "template").agg(
            F.sum("paths").alias("all_paths"), F.count("*").alias("values"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked")
        )
        many = (F.col("all_paths") >= MIN_PATHS) & (F.col("values") > MAX_DISTINCT * F.col("all_paths"))
        settled = (F.col("all_blocked") == 0) | (F.col("all_blocked") == F.col("all_labelled"))
        # Among many values only a branch with paths enough to test is held apart.
        kind = F.when(many & (F.col("paths") < MIN_PATHS), F.lit(ANY)).otherwise(F.col("branch"))
        values = values.join(parent, ["host", "template"]).withColumn("kind", kind).withColumn("settled", settled)
        values = written(values.select("host", "template", "branch", "kind", "settled", "labelled", "blocked"), "values")
        level = values.where("not settled").groupBy("host", "template", F.col("kind").alias("branch")).agg(
            F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
        )
        chosen = steps(level).withColumnRenamed("branch", "kind")
        known = values.select("host", "template", "branch", "kind", "settled").join(chosen, ["host", "template", "kind"], "left").drop("kind")
        rows = rows.join(known, ["host", "template", "branch"])
        rest = F.expr(f"repeat('/{ANY}', size(segments) - {depth})")
        rows = rows.withColumn("template", F.concat("template", F.when(F.col("settled"), rest).otherwise(F.concat(F.lit("/"), "step"))))
        rows = rows.withColumn("segments", F.when(~F.col("settled"), F.col("segments"))).drop("branch", "step", "settled")


def purities(templated: DataFrame) -> DataFrame:
    """(host, template, spoken, purity): pages with a label and the smoothed share of blocked ones."""
    level = templated.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    hosts = level.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("blocked").alias("h_blocked"))
    total = hosts.agg(((F.coalesce(F.sum("h_blocked"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("h_labelled"), F.lit(0)) + 1.0)).alias("rate")).first().rate
    by_host = hosts.select("host", _share(F.col("h_blocked"), F.col("h_labelled"), F.lit(total)).alias("host_rate"))
    return level.join(by_host, "host").select("host", "template", F.col("labelled").alias("spoken"), _share(F.col("blocked"), F.col("labelled"), F.col("host_rate")).alias("purity"))


def judge(pages: DataFrame, labels: DataFrame | None = None, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    if labels is None:
        marked = parsed.withColumn("blocked", (F.col("fit.verdict") == "block").cast("long"))
    else:
        known = labels.where("page_id is not null").groupBy("page_id").agg(F.max(F.col("blocked").cast("long")).alias("blocked"))
        marked = parsed.join(known, "page_id", "left")
    paths = marked.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("blocked").alias("labelled"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("blocked")
    )
    templated = written(path_templates(paths), "templates")
    judged = templated.select("host", "path", "template").join(written(purities(templated), "purities"), ["host", "template"])
    # Pages that no label speaks for are not blocked for their neighbours.
    own = F.when((F.col("spoken") > 0) & (F.col("purity") >= LIMIT), "block").otherwise("allow")
    return parsed.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", own).alias("verdict"), "template", "purity"
    )


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
