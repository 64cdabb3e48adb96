"""URL filter over a tree of path templates per host.

Level by level, until no url has a further segment, a path segment under its
parent stays literal if at least ``MIN_URLS`` urls have it, however many the
parent has; otherwise it becomes the wildcard ``*``. Sibling branches of equal
shape are merged into groups in which no two differ significantly in their
labelled bad rates. A template is blocked if its labelled bad rate, smoothed
towards its parent's, that towards the host's and that towards the overall rate,
reaches ``BAD_RATE``. Explicit rules go before the tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

# Fixed values of the filter's contract.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

#: A literal segment has at least so many urls.
MIN_URLS = 20
#: Branches whose rates differ by at most so many standard errors are similar.
SIMILAR_Z = 1.96
#: Fewer labels cannot differ from as many others, all good against all bad; such branches stay by themselves.
TELLING = 4
#: Branches up to which a group's segment names them all.
NAMED = 50
#: Labels that the prior counts for.
PRIOR_LABELS = 10.0
BAD_RATE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; without one, or null: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits columns ``host`` and ``path``, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((F.col("host") == domain) | F.col("host").endswith("." + domain)) & F.col("path").startswith(prefix)
        name = F.when(fits, domain + prefix).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _grow(urls: DataFrame, min_urls: int) -> tuple[DataFrame, int]:
    """``urls`` with ``template``, an array of literal segments and wildcards, and the levels that can hold literals.

    A node of fewer than ``min_urls`` urls has no literal below it, so its urls
    leave with a wildcard for each further segment; so do urls without one.
    """
    rows = urls.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != ""))
    rows = rows.withColumn("template", F.array().cast("array<string>")).withColumn("large", F.lit(True))
    done, depth = [], 0
    while True:
        rest = F.size("segments") - depth
        rows = stage(rows.withColumn("open", F.col("large") & (rest > 0)).drop("large"), "url-level")
        closed = F.concat("template", F.array_repeat(F.lit("*"), rest))
        done.append(rows.where("not open").withColumn("template", closed).drop("open", "segments"))
        rows = rows.where("open").drop("open").withColumn("segment", F.get("segments", F.lit(depth)))
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done), depth
        nodes = rows.groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        nodes = nodes.groupBy("host", "template", F.when(F.col("n") >= min_urls, F.col("segment")).alias("segment"))
        large = stage(nodes.agg(F.sum("n").alias("n")).where(F.col("n") >= min_urls).drop("n"), "url-nodes")
        literal = large.where("segment is not null").withColumn("literal", F.lit(True))
        others = large.where("segment is null").select("host", "template", F.lit(True).alias("others"))
        rows = rows.join(literal, ["host", "template", "segment"], "left").join(others, ["host", "template"], "left")
        step = F.array(F.when(F.col("literal"), F.col("segment")).otherwise("*"))
        rows = rows.withColumn("large", F.coalesce("literal", "others", F.lit(False)))
        rows = rows.withColumn("template", F.concat("template", step)).drop("literal", "others", "segment")
        depth += 1


def similar_groups(types: list[tuple[int, int]]) -> list[int]:
    """The group of each (labelled, bad) of a family's branches.

    In order of their rates (one more label of each kind added), a type joins
    the group before it if it differs from none of the group's types by
    ``SIMILAR_Z`` standard errors of two proportions, nor, having more labels
    than each of them, from all of them together.
    """
    n, b = (np.array(x, float) for x in zip(*types, strict=True))
    rate = (b + 1) / (n + 2)

    def similar(i: int, labelled: np.ndarray, bad: np.ndarray) -> np.ndarray:
        n1, n2 = n[i] + 2, labelled + 2
        pooled = (b[i] + bad + 2) / (n1 + n2)
        error = np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
        return np.abs(rate[i] - (bad + 1) / n2) <= SIMILAR_Z * error

    groups, group, members = [0] * len(types), -1, []
    for i in np.lexsort((n, rate)):
        own_n, own_b = n[members], b[members]
        fits = bool(members) and similar(i, own_n, own_b).all()
        if fits and n[i] > own_n.max():
            fits = similar(i, own_n.sum(), own_b.sum())
        if not fits:
            group, members = group + 1, []
        members.append(i)
        groups[i] = group
    return groups


def _grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [
            (host, shape, t["labelled"], t["bad"], group)
            for host, shape, types in zip(batch["host"], batch["shape"], batch["types"], strict=True)
            for t, group in zip(types, similar_groups([(t["labelled"], t["bad"]) for t in types]), strict=True)
        ]
        yield pd.DataFrame(out, columns=["host", "shape", "labelled", "bad", "group"])


def _merge(templates: DataFrame, levels: int) -> DataFrame:
    """``templates`` (host, template, labelled, bad) with ``merged``, after joining similar siblings at every depth.

    Branches of fewer than ``TELLING`` labels stay alone. Those of equal labels
    are alike, so a family's groups are found on its distinct (labelled, bad)
    pairs, of which L labels allow about L ** (2 / 3). A group's segment lists its
    branches up to ``NAMED`` of them; beyond, it gives the first and the count of
    the others (groups of a family have no branch in common, so names differ).
    """
    rows = templates.withColumn("merged", F.col("template"))
    kind = ["host", "shape", "labelled", "bad"]
    for depth in range(levels, 0, -1):
        segment = F.get("merged", F.lit(depth - 1))
        before, after = F.slice("merged", 1, depth - 1), F.slice("merged", depth + 1, F.size("merged"))
        branches = rows.where(segment.isNotNull() & (segment != "*")).groupBy("host", "merged").agg(
            F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")
        )
        branches = branches.where(F.col("labelled") >= TELLING).withColumn("segment", segment)
        branches = stage(branches.withColumn("shape", F.concat(before, F.array(F.lit("*")), after)), "url-branches")
        families = branches.select(*kind).distinct().groupBy("host", "shape").agg(F.collect_list(F.struct("labelled", "bad")).alias("types"))
        groups = families.mapInPandas(_grouped, "host string, shape array<string>, labelled long, bad long, group int")
        branches = stage(branches.join(groups, kind), "url-grouped")
        group = ["host", "shape", "group"]
        several = branches.groupBy(*group).agg(F.count("*").alias("size"), F.min("segment").alias("first")).where("size > 1")
        several = stage(several, "url-groups")
        few = branches.join(several.where(F.col("size") <= NAMED), group, "left_semi")
        names = few.groupBy(*group).agg(F.array_join(F.array_sort(F.collect_list("segment")), "|").alias("name"))
        many = several.where(F.col("size") > NAMED).select(*group, F.concat("first", F.lit("|+"), F.col("size") - 1).alias("name"))
        renamed = branches.join(names.unionByName(many), group)
        renamed = renamed.select("host", "merged", F.concat(before, F.array("name"), after).alias("renamed"))
        rows = rows.join(renamed, ["host", "merged"], "left").withColumn("merged", F.coalesce("renamed", "merged"))
        rows = stage(rows.drop("renamed"), "url-merged")
    return rows


def _smoothed(bad: Column, labelled: Column, towards: Column) -> Column:
    return (bad + PRIOR_LABELS * towards) / (labelled + PRIOR_LABELS)


def _judge(merged: DataFrame, levels: int) -> DataFrame:
    """``merged`` templates with ``bad_rate``.

    The overall rate is the prior of a host, and down the tree a node's prior is
    the rate of the nearest node above that has further labels, else the host's.
    A template's rate is that of its merged group, whose prior is the mean of
    its templates' by their labels; without labels, it is the template's prior.
    """
    overall = merged.agg(F.sum("bad").alias("b"), F.sum("labelled").alias("n")).first()
    overall = F.lit(float((overall["b"] or 0) / (overall["n"] or 1)))
    sums = (F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    hosts = merged.groupBy("host").agg(*sums)
    hosts = hosts.select("host", "n", _smoothed(F.col("b"), F.col("n"), overall).alias("rate"))
    rows = merged.join(hosts, "host").withColumn("prior", F.col("rate"))
    for depth in range(1, levels + 1):
        rows = rows.withColumnsRenamed({"n": "above", "rate": "above_rate"}).withColumn("node", F.slice("template", 1, depth))
        nodes = rows.where(F.size("template") >= depth).groupBy("host", "node").agg(*sums)
        rows = rows.join(nodes, ["host", "node"], "left")
        inside = (F.size("template") >= depth) & F.col("n").isNotNull()
        prior = F.when(inside & (F.col("n") < F.col("above")), F.col("above_rate")).otherwise(F.col("prior"))
        rows = rows.withColumn("prior", prior)
        rows = rows.withColumn("rate", F.when(inside, _smoothed(F.col("b"), F.col("n"), F.col("prior"))).otherwise(F.col("above_rate")))
        rows = rows.withColumn("n", F.when(inside, F.col("n")).otherwise(F.col("above")))
        rows = stage(rows.drop("above", "above_rate", "node", "b"), "url-priors")
    own = F.when(F.col("labelled") < F.col("n"), F.col("rate")).otherwise(F.col("prior"))
    rows = rows.select("host", "template", "merged", "labelled", "bad", own.alias("prior"))
    weighted = F.sum(F.col("prior") * F.col("labelled")) / F.sum("labelled")
    groups = rows.where("labelled > 0").groupBy("host", "merged").agg(*sums, weighted.alias("towards"))
    groups = groups.select("host", "merged", _smoothed(F.col("b"), F.col("n"), F.col("towards")).alias("group_rate"))
    rows = rows.join(groups, ["host", "merged"], "left")
    return rows.select("host", "template", "merged", F.coalesce("group_rate", "prior").alias("bad_rate"))


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str, str]] | None = None,
    min_urls: int = MIN_URLS,
    bad_rate: float = BAD_RATE,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, bad_rate``: one row per row of ``pages``.

    ``labels`` has ``doc_id`` (the page's id), ``quality`` and ``toxic``; a page is
    bad if its quality is 0 or it is toxic; of several labels the worst counts.
    Pages with a null id have no label. A null url, or one without ``://``, has
    an empty host and path. Without any label nothing is blocked by the tree.
    Repeated rows are judged alike; other columns are ignored; an empty table
    gives no rows.
    """
    urls = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path")
    )
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.max(bad.cast("int")).alias("is_bad"))
    grown, levels = _grow(urls, min_urls)
    grown = stage(grown.join(known, "page_id", "left"), "url-grown")
    templates = grown.groupBy("host", "template").agg(
        F.count("is_bad").alias("labelled"), F.coalesce(F.sum("is_bad"), F.lit(0)).alias("bad")
    )
    merged = _merge(stage(templates, "url-templates"), levels)
    judged = stage(_judge(merged, levels), "url-judged")
    name, decided = matching_rule(rules if rules is not None else RULES)
    verdict = F.coalesce(decided, F.when(F.col("bad_rate") >= bad_rate, "block").otherwise("allow"))
    return grown.join(judged, ["host", "template"]).select(
        "page_id", "host", "path", name.alias("rule"), verdict.alias("verdict"),
        F.concat(F.lit("/"), F.array_join("merged", "/")).alias("template"), "bad_rate",
    )
