"""URL filter: explicit rules first, then a tree of path templates per host.

Paths become templates: digit runs and long segments are generalised at once,
and a node whose children take more than ``max_children`` values becomes a
wildcard, level by level. Sibling branches with the same structure below them and
a labelled rate that a two-sided test cannot tell from their siblings' are merged.
A template is rejected if its labelled share of bad urls, smoothed towards the
share among all labelled urls, is high. Everything is DataFrame expressions.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import named
from ledgerloom.session import checkpointed

DEPTH = 4
MAX_CHILDREN = 32
LONG_SEGMENT = 24
STRENGTH = 10.0
PURITY = 0.9
MIN_LABELS = 5
Z_LIMIT = 2.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, bool]]) -> tuple[Column, Column]:
    """The longest fitting rule (``host/path``) and whether it blocks; nulls if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's,
    which begins with the slash.
    """
    found, blocks = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule, block in sorted(rules, key=lambda item: (len(item[0]), item[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found, blocks = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(block)).otherwise(blocks)
    return found, blocks


def _shape(path: Column) -> Column:
    """Segments with digit runs as ``0`` and long ones as ``*``; empty segments are dropped."""
    segments = F.filter(F.split(path, "/"), lambda part: part != "")
    return F.transform(
        segments,
        lambda part: F.when(F.length(part) >= LONG_SEGMENT, F.lit("*")).otherwise(F.regexp_replace(part, "[0-9]+", "0")),
    )


def templates(urls: DataFrame, max_children: int = MAX_CHILDREN) -> DataFrame:
    """One row per (``host``, ``shape``) of ``urls`` (host, path, bad): its ``template`` and label counts.

    ``bad`` is null for unlabelled urls. The first ``DEPTH`` segments make the
    tree; deeper ones only say that something follows (``**``).
    """
    shapes = checkpointed(
        urls.select("host", F.array_join(_shape(F.col("path")), "/").alias("shape"), "bad")
        .groupBy("host", "shape")
        .agg(F.count("bad").alias("labelled"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("n_bad"))
    )
    parts = F.split(F.col("shape"), "/")
    tree = shapes.withColumn("template", F.lit(""))
    for depth in range(DEPTH):
        part = F.when((F.size(parts) > depth) & (F.col("shape") != ""), F.element_at(parts, depth + 1))
        tree = tree.withColumn("part", part)
        variable = (
            tree.filter(F.col("part").isNotNull())
            .select("host", "template", "part")
            .distinct()
            .groupBy("host", "template")
            .agg(F.count("*").alias("children"))
            .filter(F.col("children") > max_children)
        )
        tree = tree.join(variable, ["host", "template"], "left").withColumn(
            "template",
            F.when(F.col("part").isNull(), F.col("template")).otherwise(
                F.concat("template", F.lit("/"), F.when(F.col("children").isNotNull(), F.lit("*")).otherwise(F.col("part")))
            ),
        ).drop("children", "part")
    deeper = F.size(parts) > DEPTH
    return tree.withColumn("template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template")))


def rejected_shapes(
    urls: DataFrame,
    max_children: int = MAX_CHILDREN,
    strength: float = STRENGTH,
    purity: float = PURITY,
    min_labels: int = MIN_LABELS,
    z_limit: float = Z_LIMIT,
) -> DataFrame:
    """``host`` and ``shape`` of the templates that are rejected by their labelled urls.

    Branches are siblings if host and all but the first segment of the template
    agree. A labelled branch joins its siblings' pool if its rate lies within
    ``z_limit`` standard errors of the pool's; others stand alone. Templates with
    fewer than ``min_labels`` labels are never rejected.
    """
    tree = checkpointed(templates(urls, max_children))
    nodes = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("n_bad").alias("n_bad"))
    nodes = checkpointed(
        nodes.filter(F.col("labelled") > 0).withColumn("below", F.regexp_replace("template", "^/[^/]*", ""))
    )
    pools = nodes.groupBy("host", "below").agg(F.sum("labelled").alias("all_labelled"), F.sum("n_bad").alias("all_bad"))
    rate, pool_rate = F.col("n_bad") / F.col("labelled"), F.col("all_bad") / F.col("all_labelled")
    similar = (rate - pool_rate) * (rate - pool_rate) * F.col("labelled") <= (
        z_limit * z_limit * pool_rate * (F.lit(1.0) - pool_rate)
    )
    branches = nodes.join(pools, ["host", "below"]).withColumn("merged", similar)
    merged = (
        branches.filter("merged").groupBy("host", "below")
        .agg(F.sum("labelled").alias("pool_labelled"), F.sum("n_bad").alias("pool_bad"))
    )
    prior = nodes.agg(((F.sum("n_bad") + 1) / (F.sum("labelled") + 2)).alias("prior"))
    judged = branches.join(merged, ["host", "below"], "left").select(
        "host", "template",
        F.when(F.col("merged"), F.col("pool_labelled")).otherwise(F.col("labelled")).alias("seen"),
        F.when(F.col("merged"), F.col("pool_bad")).otherwise(F.col("n_bad")).alias("bad"),
    )
    share = prior.first()[0]
    smoothed = (F.col("bad") + strength * F.lit(share)) / (F.col("seen") + strength)
    rejected = judged.filter((F.col("seen") >= min_labels) & (smoothed >= purity))
    return tree.join(rejected.select("host", "template"), ["host", "template"], "left_semi").select("host", "shape")


def judged_urls(
    pages: DataFrame, rules: Sequence[tuple[str, bool]], id_column: str = "page_id", url_column: str = "url",
    bad: Column | None = None,
) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` and ``verdict`` (``allow`` or ``block``) of every url.

    The longest fitting rule decides. Where none fits, the url's template does,
    learned from the urls that are labelled: by ``bad``, a boolean column of
    ``pages``, or by default by the rules themselves.

    A null url, or one without ``://``, has empty host and path and is judged
    like any other. Null ids and repeated rows each come back. Empty paths are a
    template of their own. An empty table gives no rows. Other columns are
    ignored. Counts are combined before each shuffle; joins are on (host, shape)
    or (host, template) and may be split where a host is hot.
    """
    url = F.col(f"`{url_column}`").cast("string")
    found, blocks = rule_of(F.col("host"), F.col("path"), rules)
    known = (
        pages.select(*named(id=id_column), host_of(F.coalesce(url, F.lit(""))).alias("host"),
                     path_of(F.coalesce(url, F.lit(""))).alias("path"), (F.lit(None).cast("boolean") if bad is None else bad).alias("given"))
        .withColumn("rule", found)
        .withColumn("blocks", blocks)
        .withColumn("bad", F.coalesce("given", "blocks"))
    )
    rejected = rejected_shapes(known.select("host", "path", "bad")).withColumn("rejected", F.lit(True))
    shaped = known.withColumn("shape", F.array_join(_shape(F.col("path")), "/"))
    verdict = F.when(F.coalesce("blocks", "rejected", F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return shaped.join(rejected, ["host", "shape"], "left").select("id", "host", "path", "rule", verdict.alias("verdict"))
