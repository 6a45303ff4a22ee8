"""URL filter by path-template trees.

A url's host and path give the branch of a tree: per host, level by level, the path's
segments.  Segments that vary are wildcards: runs of digits and long segments by their
look, and all children of a node with more than ``branches`` different ones.  Of the
remaining children of a node, neighbours in the order of their labelled share of good
pages become one branch unless a two-sample test tells them apart.  Every node's purity is its
labelled share of good pages, smoothed towards the purity of its parent (the host's
towards the corpus's); urls of templates below the threshold are blocked.  Fixed rules
go before the tree.

All counts are over distinct (host, shape) rows that are aggregated before they are
shuffled, so a host with a third of all pages costs one row per task and shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, materialize, quoted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of a segment beyond which it is a wildcard by itself.
LONG_SEGMENT = 64

#: (verdict, rule): host up to the first slash, then the path's beginning.
Rules = list[tuple[str, str]]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both are empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Rules) -> Column:
    """(rule, verdict) of the longest rule that fits; null fields if none does.  ``rules`` is a short list."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + start))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape(path: Column, depth: int) -> Column:
    """The path's first ``depth`` segments with runs of digits as ``#`` and long ones as ``*``; ``**`` stands for the rest."""
    parts = F.when(path == "", F.array().cast("array<string>")).otherwise(F.split(F.substring(path, 2, 2**31 - 1), "/", -1))
    general = F.transform(F.slice(parts, 1, depth), lambda s: F.when(F.length(s) > LONG_SEGMENT, "*")
                          .otherwise(F.regexp_replace(s, "[0-9]+", "#")))
    return F.when(F.size(parts) > depth, F.concat(general, F.array(F.lit("**")))).otherwise(general)


def smoothed(good: Column, labelled: Column, parent: Column, weight: float) -> Column:
    return (good + weight * parent) / (labelled + weight)


def apart(good: Column, labelled: Column, other_good: Column, other_labelled: Column, z: float) -> Column:
    """Whether two labelled shares differ: squared two-sample z statistic with pooled variance above z squared.
    Branches without labels differ from none."""
    both = labelled + other_labelled
    pooled = (good + other_good) / both
    gap = good / labelled - other_good / other_labelled
    return F.when((labelled > 0) & (other_labelled > 0),
                  gap * gap > z * z * pooled * (1 - pooled) * (1 / labelled + 1 / other_labelled)).otherwise(False)


def template_tree(shapes: DataFrame, branches: int, z: float, weight: float) -> DataFrame:
    """(host, shape, template, purity) of distinct (host, shape) rows with counts ``good`` and ``labelled``.

    One round per level: children are summed per node, nodes with many children get one
    wildcard, the others' children are merged, and the rows move on to their branch.
    """
    sums = [F.sum(c).cast("double").alias(c) for c in ("good", "labelled")]
    total = shapes.agg(*sums, F.max(F.size("shape")).alias("levels")).first()
    prior = ((total.good or 0.0) + weight * 0.5) / ((total.labelled or 0.0) + weight)
    hosts = shapes.groupBy("host").agg(*sums).select(
        "host", smoothed(F.col("good"), F.col("labelled"), F.lit(prior), weight).alias("purity"))
    tree = materialize(shapes.join(hosts, "host").withColumn("template", F.lit("")), "url-hosts")
    node = ["host", "template"]
    for level in range(total.levels or 0):
        here = tree.withColumn("segment", F.get("shape", F.lit(level)))
        kids = (here.where(F.col("segment").isNotNull()).groupBy(*node, "segment")
                .agg(*sums, F.first("purity").alias("parent")))
        kids = materialize(kids, "url-branches")
        nodes = kids.groupBy(*node).agg(F.count("*").alias("fan"), *sums, F.first("parent").alias("parent"))
        wide = nodes.where(F.col("fan") > branches)
        share = F.when(F.col("labelled") > 0, F.col("good") / F.col("labelled"))
        beside = Window.partitionBy(*node).orderBy(share.asc_nulls_last(), "segment")
        merged = (kids.join(wide.select(*node), node, "left_anti")  # at most ``branches`` children a node
                  .withColumn("cut", apart(F.col("good"), F.col("labelled"), F.lag("good").over(beside),
                                           F.lag("labelled").over(beside), z).cast("int"))
                  .withColumn("branch", F.sum(F.coalesce("cut", F.lit(0))).over(beside.rowsBetween(Window.unboundedPreceding, 0))))
        merged = (merged.groupBy(*node, "branch")
                  .agg(*sums, F.first("parent").alias("parent"), F.sort_array(F.collect_list("segment")).alias("segments"))
                  .withColumn("label", F.array_join("segments", "|")).select(*node, "good", "labelled", "parent", "segments", "label"))
        own = merged.select(*node, F.explode("segments").alias("segment"), "label",
                            smoothed(F.col("good"), F.col("labelled"), F.col("parent"), weight).alias("own"))
        wild = wide.select(*node, smoothed(F.col("good"), F.col("labelled"), F.col("parent"), weight).alias("wild"))
        moved = here.join(wild, node, "left").join(own, [*node, "segment"], "left")
        label = F.when(F.col("wild").isNotNull(), "*").otherwise(F.col("label"))
        on = F.col("segment").isNotNull()
        tree = materialize(moved.select(
            "host", "shape", "good", "labelled",
            F.when(on, F.coalesce("wild", "own")).otherwise(F.col("purity")).alias("purity"),
            F.when(on, F.concat("template", F.lit("/"), label)).otherwise(F.col("template")).alias("template")), "url-level")
    return tree.select("host", "shape", "template", "purity")


def judge_urls(df: DataFrame, rules: Rules, label_col: str, threshold: float = 0.5, branches: int = 16, z: float = 1.96,
               weight: float = 10.0, depth: int = 8, url_col: str = "url") -> DataFrame:
    """All columns of ``df`` plus host, path, rule, template, purity and verdict.

    ``label_col`` is 1 on good pages, 0 on bad ones and null on unlabelled ones.  The
    verdict is that of the longest fitting rule, else ``block`` where the smoothed purity of
    the url's template is below ``threshold``, else ``allow``.  A rule ``host/start`` fits its
    host and all subdomains where the path begins with ``/start``; an empty path begins
    with no rule's path.

    A null url, or one without ``://``, has an empty host and path and is judged by
    the purity of that host.  Urls of any length are parsed whole; path levels beyond ``depth`` are one
    wildcard.  Repeated rows are counted and judged one by one; ties between branches go by
    segment.  Columns of ``df`` with one of the six names are replaced; an empty
    table gives an empty result.
    """
    added = ("host", "path", "rule", "template", "purity", "verdict")
    host, path = url_parts(quoted(url_col).cast("string"))
    (label,) = fresh(df, "label_of_page")
    names = [c for c in df.columns if c.lower() not in added]
    (key,) = fresh(df.select(*map(quoted, names)), "shape")
    parsed = (df.select(*map(quoted, names), quoted(label_col).cast("int").alias(label), host.alias("host"), path.alias("path"))
              .withColumn(key, shape(F.col("path"), depth)))
    marked = F.col(label)
    shapes = (parsed.groupBy("host", F.col(key).alias("shape"))
              .agg(F.sum(F.coalesce((marked == 1).cast("int"), F.lit(0))).alias("good"), F.count(marked).alias("labelled")))
    tree = template_tree(materialize(shapes, "url-shapes"), branches, z, weight).withColumnRenamed("shape", key)
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    return (parsed.withColumn("rule", rule).join(tree, ["host", key], "left")
            .withColumn("verdict", F.coalesce(F.col("rule.verdict"), F.when(F.col("purity") < threshold, "block").otherwise("allow")))
            .select(*map(quoted, names), "host", "path", F.col("rule.rule").alias("rule"), "template", "purity", "verdict"))
