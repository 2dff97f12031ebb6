"""URL filter by a tree of path templates. Built-in expressions only.

Per host, the paths make a tree of segments, grown from aggregated paths. What all paths of a node
have in common goes to its template at once, so that each round is a place where paths part:

* runs of digits are `{n}` and long hexadecimal names `{x}` from the start;
* a child is comparable if it has labels enough for the test to tell it from all children: were its
  labels all good or all bad, it would differ (two-sided, `Z` standard errors);
* comparable children that do not differ are merged into one branch, `~`; those that differ stay;
* children that are not comparable are variable if pages spread over at least `SPREAD` of the
  children, (sum of pages)^2 / sum of pages^2: they become one wildcard, `*`. Else they stay.

None of these depends on the size of the crawl: with k times the pages the spread is the same.

A template, a path of this tree, is rejected if its smoothed share of bad labels is `REJECT` or
more: (bad + A * prior) / (labels + A), where the prior is the host's share, smoothed in the same
way towards the share of all hosts. Fixed rules go before templates: of the rules that fit, the
longest decides.

Pages are counted per host and path shape first (combined before the shuffle), so the tree's
steps grow with different shapes and a host with a third of all pages is no heavier than its
shapes; each round is an aggregate and a join on it, and no window holds a node's children. Rounds
go on until no path has a further segment, however deep.

Defined cases: a null URL, or one without `://`, has an empty host and path; a null label is no
label; without any labels nothing is rejected; repeated rows are judged alike; an empty table
gives an empty result; columns beyond those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrospark.llm.common import written

#: (verdict, host and path); a rule holds for its host and all hosts below it.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SPREAD = 8
Z = 1.96
A = 8.0
REJECT = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first `://` to the next `/`, `?` or `#`, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host, up to `?` or `#`."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(say)).otherwise(verdict)
    return name, verdict


def shape_of(path: Column) -> Column:
    """The segments of a path without what numbers and identifiers make different."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    named = lambda s: F.regexp_replace(s, "[0-9]+", "{n}")
    hexed = lambda s: F.when(s.rlike("^[0-9a-fA-F-]{8,}$") & s.rlike("[a-fA-F]"), F.lit("{x}")).otherwise(named(s))
    return F.transform(segments, hexed)


def _share(bad: Column, labels: Column, prior: Column) -> Column:
    return (bad + F.lit(A) * prior) / (labels + F.lit(A))


_COUNTS = ("pages", "labels", "bad")


def _common(paths: DataFrame) -> DataFrame:
    """Each path moved on by the segments that all paths of its node share: those of its least and greatest path."""
    ends = paths.groupBy("host", "template").agg(F.min("rest").alias("least"), F.max("rest").alias("greatest"))
    parted = F.filter(
        F.sequence(F.lit(1), F.least(F.size("least"), F.size("greatest")) + 1),
        lambda i: ~F.get("least", i - 1).eqNullSafe(F.get("greatest", i - 1)) | (i > F.least(F.size("least"), F.size("greatest"))),
    )
    shared = ends.select("host", "template", F.slice("greatest", F.lit(1), parted[0] - 1).alias("shared"))
    moved = paths.join(shared, ["host", "template"])
    rest = F.slice("rest", F.size("shared") + 1, F.greatest(F.size("rest"), F.lit(1)))
    return moved.withColumn("rest", rest).withColumn(
        "template", F.concat("template", F.array_join(F.transform("shared", lambda s: F.concat(F.lit("/"), s)), ""))
    ).select(*paths.columns)


def _grown(paths: DataFrame) -> DataFrame:
    """One parting more of the tree: each path's next segment becomes itself, `*` or `~`."""
    here = _common(paths).withColumn("segment", F.get("rest", F.lit(0)))
    children = here.where("segment is not null").groupBy("host", "template", "segment").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    square = F.col("pages").cast("double") * F.col("pages")
    parents = children.groupBy("host", "template").agg(
        F.count(F.lit(1)).alias("branches"), F.sum(square).alias("squares"), *[F.sum(c).alias(f"all_{c}") for c in _COUNTS]
    )
    known = children.join(parents, ["host", "template"])
    rate = F.col("all_bad") / F.greatest("all_labels", F.lit(1))
    error = F.lit(Z) * F.sqrt(F.col("labels") * rate * (1 - rate))
    comparable = (F.col("labels") > 0) & (F.col("labels") * F.greatest(rate, 1 - rate) > error)
    alike = F.abs(F.col("bad") - F.col("labels") * rate) <= error
    variable = F.col("all_pages").cast("double") * F.col("all_pages") >= SPREAD * F.col("squares")
    named = F.when(F.col("branches") == 1, F.col("segment")).when(comparable, F.when(alike, "~").otherwise(F.col("segment")))
    names = known.select("host", "template", "segment", named.otherwise(F.when(variable, "*").otherwise(F.col("segment"))).alias("name"))
    return written(
        here.join(names, ["host", "template", "segment"], "left")
        .withColumn("template", F.when(F.col("name").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "name")))
        .withColumn("rest", F.slice("rest", F.lit(2), F.greatest(F.size("rest"), F.lit(1))))
        .select(*paths.columns),
        "url-tree",
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, labels, bad, bad_share, rejected) of pages (host, shape, bad as 0, 1 or null)."""
    paths = written(
        pages.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
        ).withColumn("template", F.lit("")).withColumn("rest", F.col("shape")),
        "url-paths",
    )
    while not paths.where(F.size("rest") > 0).isEmpty():
        paths = _grown(paths)
    found = paths.groupBy("host", "template").agg(F.sum("labels").alias("labels"), F.sum("bad").alias("bad"))
    hosts = found.groupBy("host").agg(F.sum("labels").alias("host_labels"), F.sum("bad").alias("host_bad"))
    base = hosts.agg((F.sum("host_bad") / F.greatest(F.sum("host_labels"), F.lit(1))).alias("base")).first()["base"]
    prior = _share(F.col("host_bad"), F.col("host_labels"), F.lit(base or 0.0))
    judged = found.join(hosts.select("host", prior.alias("prior")), "host")
    judged = judged.withColumn("bad_share", _share(F.col("bad"), F.col("labels"), F.col("prior")))
    judged = judged.withColumn("rejected", F.col("bad_share") >= REJECT)
    return paths.select("host", "shape", "template").join(judged.drop("prior"), ["host", "template"])


def judge(pages: DataFrame, url: str = "url", bad: str | None = None, keep: Sequence[str] = (), rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """`keep` columns, then host, path, rule, verdict and template of each page.

    `bad` names a column that is 1 for a bad page, 0 for a good one, and null without a label.
    """
    label = F.lit(None).cast("int") if bad is None else F.col(bad).cast("int")
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None)
    rows = pages.select(kept.alias("kept"), F.col(url).alias("url"), label.alias("bad"))
    rows = rows.select("kept", "bad", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("shape", shape_of(F.col("path")))
    tree = templates(rows.select("host", "shape", "bad")).select("host", "shape", "template", "rejected")
    rule, say = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(say, F.when(F.col("rejected"), "block").otherwise("allow"))
    return rows.join(tree, ["host", "shape"]).select(
        *([F.col(f"kept.`{c}`") for c in keep]), "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template"
    )


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages with the label of the document whose number ends the path: bad if of low quality or toxic."""
    number = F.regexp_extract(path_of(F.col("url")), "([0-9]{1,18})[^0-9/]*/?$", 1)
    rows = pages.select("page_id", "url", F.when(number != "", number.cast("bigint")).alias("number"))
    worse = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull(), 0))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("number")).agg(worse.alias("bad"))
    return rows.join(known, "number", "left")


def digest_columns(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, template."""
    return judge(labelled(pages, labels), bad="bad", keep=["page_id"])
