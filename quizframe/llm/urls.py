"""URL filter: rules first, then a tree of path templates per host.

* **Parsing.** Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
  lower-cased. Path: then up to ``?``, ``#`` or the end. NULL or no ``://``: both empty.
* **Rules** are (verdict, host and path); one fits its host and all subdomains if the
  path starts with the rule's. The longest decides. The urls it decides are the labels
  of the method.
* **Template tree.** Paths are cut into segments. Segments of digits, of hex digits, and
  file names of digits are variable by shape. Then, level by level from the host down,
  a node with more than ``FAN`` children keeps the children that hold a share of
  1 / ``FAN`` of its urls and puts the others under one wildcard ``{*}``.
* **Merging.** Level by level from the deepest branches up, sister branches become one if
  they are statistically similar: the same profile of what lies below them (shares in
  eighths) and, where both have labelled urls, the same share of blocked ones among these
  (in quarters). A branch without labels joins the labelled ones of its profile if they
  agree, whatever their numbers; if they differ, those without labels stay among
  themselves. They are grouped by that signature, not compared in pairs. A wildcard stays
  apart from named branches.
* **Verdict.** A template is rejected if its share of blocked urls among the labelled
  ones, smoothed by ``WEIGHT`` urls of the overall share, is at least ``REJECT``.

Urls are counted per (host, template) first, so a host with a third of all urls is a
few rows when the tree is built; urls meet their template again in a join whose skew
adaptive execution splits. Beyond ``DEPTH`` segments, the rest of a path is one segment,
with its shapes named, so different deep paths stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizframe.runtime import written

# The rules of the contract.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
FAN = 12
DEPTH = 8
WEIGHT = 10
REJECT = 0.9
WILD = "{*}"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` and ``path``; columns of these names are replaced."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    kept = [c for c in urls.columns if c not in ("host", "path")]
    return urls.select(
        *kept, F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path")
    )


def decided(rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, from ``host`` and ``path``; NULL without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def shapes(path: str) -> Column:
    """Segments of the path with variable shapes named; all beyond DEPTH are one segment."""

    def shape(s: Column) -> Column:
        return (
            F.when(s.rlike("^[0-9]+$"), F.lit("{n}"))
            .when(s.rlike("^[0-9]+\\.[A-Za-z]{1,5}$"), F.concat(F.lit("{n}."), F.substring_index(s, ".", -1)))
            .when(s.rlike("^[0-9a-fA-F-]{8,}$") & s.rlike("[0-9]"), F.lit("{x}"))
            .otherwise(s)
        )

    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape)
    tail = F.array_join(F.slice(segments, DEPTH + 1, F.greatest(F.size(segments) - DEPTH, F.lit(0))), "/")
    return F.when(F.size(segments) > DEPTH, F.concat(F.slice(segments, 1, DEPTH), F.array(tail))).otherwise(segments)


def _widened(nodes: DataFrame, level: int) -> DataFrame:
    """``nodes`` (host, shape, template, counts) with rare children at ``level`` put under a wildcard."""
    inner = nodes.filter(F.size("template") > level)
    prefix = F.slice("template", 1, level) if level else F.array().cast("array<string>")
    child = F.col("template")[level]
    children = inner.groupBy("host", prefix.alias("prefix"), child.alias("child")).agg(F.sum("n").alias("n"))
    fans = (
        children.groupBy("host", "prefix")
        .agg(F.count("*").alias("fan"), F.sum("n").alias("total"))
        .filter(F.col("fan") > FAN)
    )
    rare = children.join(fans, ["host", "prefix"]).filter(F.col("n") * FAN < F.col("total")).select("host", "prefix", "child", F.lit(True).alias("rare"))
    marked = nodes.withColumn("prefix", prefix).withColumn("child", F.get("template", F.lit(level))).join(rare, ["host", "prefix", "child"], "left")
    wild = F.concat("prefix", F.array(F.lit(WILD)), F.slice("template", level + 2, DEPTH + 1))
    return marked.select(
        "host", "shape", F.when(F.col("rare"), wild).otherwise(F.col("template")).alias("template"), "n", "blocked", "labelled"
    )


def _merged(nodes: DataFrame, level: int) -> DataFrame:
    """``nodes`` with similar sister branches at ``level`` named as one."""
    prefix = F.slice("template", 1, level) if level else F.array().cast("array<string>")
    inside = (F.size("template") > level + 1) & (F.get("template", F.lit(level)) != WILD)
    place = ["host", "prefix", "branch"]
    marked = nodes.withColumn("prefix", prefix).withColumn("branch", F.when(inside, F.get("template", F.lit(level))))
    rest = F.array_join(F.slice("template", level + 2, DEPTH + 1), "/")
    below = marked.filter(inside).groupBy(*place, rest.alias("below")).agg(
        *[F.sum(c).alias(c) for c in ("n", "blocked", "labelled")]
    )
    whole = Window.partitionBy(*place)
    profile = below.withColumn("share", F.round(8 * F.col("n") / F.sum("n").over(whole)).cast("int"))
    signatures = profile.groupBy(*place).agg(
        F.array_sort(F.collect_set(F.when(F.col("share") > 0, F.concat_ws(":", "below", "share")))).alias("profile"),
        F.round(4 * F.try_divide(F.sum("blocked"), F.sum("labelled"))).cast("int").alias("lean"),
    )
    # Per profile: the lean of the labelled branches, if they have one only; -1 if they differ or there are none.
    said = signatures.groupBy("host", "prefix", "profile").agg(
        F.when(F.min("lean") == F.max("lean"), F.min("lean")).otherwise(-1).alias("one")
    )
    alike = ["host", "prefix", "profile", "lean"]
    signatures = signatures.join(said, alike[:3]).withColumn("lean", F.coalesce("lean", "one")).drop("one")
    groups = signatures.groupBy(*alike).agg(F.min("branch").alias("name"), F.count("*").alias("sisters"))
    names = signatures.join(groups.filter("sisters > 1"), alike).select(*place, F.concat(F.lit("{"), "name", F.lit("~}")).alias("name"))
    renamed = F.concat("prefix", F.array("name"), F.slice("template", level + 2, DEPTH + 1))
    return marked.join(names, place, "left").select(
        "host", "shape", F.when(F.col("name").isNotNull(), renamed).otherwise(F.col("template")).alias("template"), "n", "blocked", "labelled"
    )


def judged(urls: DataFrame, key: str = "page_id", url: str = "url", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``(key, host, path, rule, verdict, template, purity)`` of every row."""
    rule, said = decided(rules)
    rows = (
        parsed(urls.select(F.col(key).alias("key"), F.col(url).alias("url")), "url")
        .withColumn("rule", rule)
        .withColumn("said", said)
        .withColumn("shape", shapes("path"))
        .drop("url")
    )
    counts = written(
        rows.groupBy("host", "shape").agg(
            F.count("*").alias("n"),
            F.count_if(F.col("said") == "block").alias("blocked"),
            F.count("said").alias("labelled"),
        ),
        "shapes",
    )
    nodes = counts.withColumn("template", F.col("shape"))
    total = nodes.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l"), F.max(F.size("template")).alias("depth")).first()
    base = F.lit((total["b"] or 0) / total["l"] if total["l"] else 0.0)
    for level in range(total["depth"] or 0):
        nodes = written(_widened(nodes, level), "templates")
    for level in range((total["depth"] or 0) - 2, -1, -1):
        nodes = written(_merged(nodes, level), "templates")
    templates = nodes.groupBy("host", "template").agg(
        ((F.sum("blocked") + WEIGHT * base) / (F.sum("labelled") + WEIGHT)).alias("purity")
    )
    named = nodes.select("host", "shape", "template").join(templates, ["host", "template"]).select(
        "host", "shape", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity"
    )
    return rows.join(named.hint("merge"), ["host", "shape"]).select(
        F.col("key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("said", F.when(F.col("purity") >= REJECT, "block").otherwise("allow")).alias("verdict"),
        "template",
        "purity",
    )
