"""URL filters: a tree of path templates per host, rejected by smoothed labelled purity.

Every path of a host is a way down a tree, one segment a level. From the root down, the
children of a node that have `MIN_PAGES` pages and one page in `SHARE` of their parent's are
its literal branches; all others, ids, dates and titles, rare each, become the wildcard `*`.
Then statistically similar branches merge: a literal branch becomes the wildcard, or else the
largest literal branch before it, if neither the share of labelled pages that are blocked nor
the share of pages that go deeper differs by more than Hoeffding's bound allows at `ALPHA`. A
branch without labels is similar to none.

What a path becomes is its template, such as `/en/*`. A template is rejected if its smoothed
share of blocked pages among labelled ones is above `REJECTED`. Segments beyond `MAX_DEPTH`
are one last segment `**`.

All of it are column functions, groupings and joins. A host may hold any share of the pages:
pages are counted per path first, counts per node are partially aggregated, and joins on the
host split what one key fills.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ranking import top_in_group
from .shared import hot_join, kept, unused

MAX_DEPTH = 6
MIN_PAGES = 3
SHARE = 20
ALPHA = 0.05

# Smoothing: so many labelled pages are added to each template, PRIOR of them blocked.
WEIGHT = 4.0
PRIOR = 0.25
REJECTED = 0.5

# Hoeffding's bound for n observations is this over the root of n.
BOUND = math.sqrt(0.5 * math.log(2 / ALPHA))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST = r"://([^/?#]*)"
PATH = r"://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Blocks or allows the urls of a host and its subdomains whose path begins with `path`."""

    host: str
    path: str
    block: bool

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: str = "url") -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    """What follows the host up to `?`, `#` or the end; empty without a host's `://`."""
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(rules: Sequence[Rule], host: str, path: str) -> Column:
    """The name of the longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is asked first
        own = (F.col(host) == rule.host) | F.endswith(F.col(host), F.lit(f".{rule.host}"))
        fits = own & F.startswith(F.col(path), F.lit(rule.path))
        found = F.when(fits, F.lit(rule.name)).otherwise(found)
    return found


def _segments() -> Column:
    found = F.filter(F.split("path", "/"), lambda s: s != "")
    rest = F.when(F.size(found) > MAX_DEPTH, F.array(F.lit("**"))).otherwise(
        F.array().cast("array<string>")
    )
    return F.concat(F.slice(found, 1, MAX_DEPTH), rest)


def _counted(labelled: DataFrame) -> DataFrame:
    """(host, path, segments, template, pages, blocked, allowed), one row per host and path."""
    return (
        labelled.groupBy("host", "path")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.count_if("blocked").alias("blocked"),
            F.count_if(~F.col("blocked")).alias("allowed"),
        )
        .select("host", "path", _segments().alias("segments"), F.lit("").alias("template"),
                "pages", "blocked", "allowed")
    )


def _near(a: Column, of_a: Column, b: Column, of_b: Column) -> Column:
    """Whether two shares differ by less than Hoeffding's bound; false where one is of nothing."""
    bound = F.lit(BOUND) / F.sqrt(of_a) + F.lit(BOUND) / F.sqrt(of_b)
    near = F.abs(F.try_divide(a, of_a) - F.try_divide(b, of_b)) < bound
    return F.when((of_a > 0) & (of_b > 0), near).otherwise(False)


def _similar(a: dict[str, Column], b: dict[str, Column]) -> Column:
    labelled = [x["blocked"] + x["allowed"] for x in (a, b)]
    return _near(a["blocked"], labelled[0], b["blocked"], labelled[1]) & _near(
        a["deeper"], a["pages"], b["deeper"], b["pages"]
    )


COUNTS = ("pages", "blocked", "allowed", "deeper")


def _branches(paths: DataFrame, depth: int) -> DataFrame:
    """(host, template, branches): for each node the branch of each child that is not `*`.

    At most `SHARE` children of a node can have their share of its pages.
    """
    deeper = F.when(F.size("segments") > depth + 1, F.col("pages")).otherwise(0)
    children = (
        paths.where(F.size("segments") > depth)
        .groupBy("host", "template", F.get("segments", F.lit(depth)).alias("segment"))
        .agg(*[F.sum(deeper if c == "deeper" else c).alias(c) for c in COUNTS])
    )
    node = ["host", "template"]
    totals = children.groupBy(*node).agg(*[F.sum(c).alias(f"all_{c}") for c in COUNTS])
    largest = top_in_group(
        children.where(F.col("pages") >= MIN_PAGES), node, [F.desc("pages"), F.asc("segment")], SHARE
    )
    literal = F.struct((-F.col("pages")).alias("order"), "segment", *COUNTS)
    found = (
        hot_join(largest, totals, node)
        .where((F.col("pages") * SHARE >= F.col("all_pages")) & ~F.col("segment").isin("*", "**"))
        .groupBy(*node)
        .agg(
            F.array_sort(F.collect_list(literal)).alias("found"),
            *[F.first(f"all_{c}").alias(f"all_{c}") for c in COUNTS],
        )
    )

    def rare(count: str) -> Column:
        own = F.aggregate("found", F.lit(0).cast("bigint"), lambda n, c: n + c[count])
        return F.col(f"all_{count}") - own

    def branch(child: Column, place: Column) -> Column:
        own = {c: child[c] for c in COUNTS}
        before = F.filter(
            F.slice("found", F.lit(1), place), lambda other: _similar(own, {c: other[c] for c in COUNTS})
        )
        like_rare = _similar(own, {c: F.col(f"rare_{c}") for c in COUNTS})
        return F.struct(
            child["segment"].alias("segment"),
            F.when(like_rare, "*")
            .otherwise(F.coalesce(F.get(before, F.lit(0))["segment"], child["segment"]))
            .alias("branch"),
        )

    return found.withColumns({f"rare_{c}": rare(c) for c in COUNTS}).select(
        *node, F.map_from_entries(F.transform("found", branch)).alias("branches")
    )


def _templates(labelled: DataFrame) -> DataFrame:
    """What `_counted` gives with the template of every path, level by level."""
    paths = kept(_counted(labelled), "url-paths")
    deepest = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    for depth in range(min(deepest, MAX_DEPTH)):
        segment = F.get("segments", F.lit(depth))
        branch = F.coalesce(F.try_element_at("branches", segment), F.lit("*"))
        step = F.concat(F.lit("/"), branch)
        below = F.when(F.size("segments") > depth, step).otherwise("")
        paths = kept(
            hot_join(paths, _branches(paths, depth), ["host", "template"], "left")
            .withColumn("template", F.concat("template", below))
            .drop("branches"),
            "url-paths",
        )
    if deepest > MAX_DEPTH:
        tail = F.when(F.size("segments") > MAX_DEPTH, "/**").otherwise("")
        paths = paths.withColumn("template", F.concat("template", tail))
    return paths


def _judged(templates: DataFrame) -> DataFrame:
    labelled = F.col("blocked") + F.col("allowed")
    purity = (F.col("blocked") + F.lit(WEIGHT * PRIOR)) / (labelled + F.lit(WEIGHT))
    return templates.withColumn("purity", purity).withColumn("rejected", purity > REJECTED)


def fit(urls: DataFrame, url: str = "url", blocked: str = "blocked") -> tuple[DataFrame, DataFrame]:
    """(templates, paths) of urls with a boolean label, null where there is none.

    templates: host, template, pages, blocked, allowed, purity, rejected. paths: host, path,
    template, rejected, for every path of the table. Null urls and urls without `://` are the
    empty path of the empty host. No urls give no rows.
    """
    labelled = urls.select(
        host_of(url).alias("host"), path_of(url).alias("path"), F.col(blocked).alias("blocked")
    )
    paths = _templates(labelled).select("host", "path", "template", "pages", "blocked", "allowed")
    sums = [F.sum(c).alias(c) for c in ("pages", "blocked", "allowed")]
    templates = _judged(paths.groupBy("host", "template").agg(*sums))
    verdicts = templates.select("host", "template", "rejected")
    placed = hot_join(paths.select("host", "path", "template"), verdicts, ["host", "template"])
    return templates, placed


def judged(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> tuple[DataFrame, str]:
    """Every row with a struct (host, path, rule, verdict), and that column's name.

    The longest rule that fits decides, whatever the templates say, and labels the url; other
    urls go by their template. All other columns stay, whatever their names; the struct is
    `url_filter`, or that behind underscores where it is taken. Repeated rows stay.
    """
    rows = pages.select(
        F.struct("*").alias("row"), host_of(url).alias("host"), path_of(url).alias("path"), F.col(url).alias("url")
    ).withColumn("rule", rule_of(rules, "host", "path"))
    by_rule = F.col("rule").isin([r.name for r in rules if r.block])
    _, paths = fit(rows.withColumn("blocked", by_rule), "url")
    rejected = paths.where("rejected").select("host", "path", "rejected")
    found = hot_join(rows.drop("url"), rejected, ["host", "path"], "left")
    blocks = F.coalesce(by_rule, "rejected", F.lit(False))
    verdict = F.when(blocks, "block").otherwise("allow").alias("verdict")
    name = unused(pages, "url_filter")
    return found.select("row.*", F.struct("host", "path", "rule", verdict).alias(name)), name
