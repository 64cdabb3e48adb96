"""Connected components over a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage

#: The alternating star steps halve path lengths; this many rounds are far beyond any real chain.
MAX_ROUNDS = 60


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written out, so that the join below sees two plain exchanges and adaptive execution can split a hot node.
    low = stage(both.groupBy("u").agg(F.min("v").alias("m")), "star-min")
    return (
        both.join(low, "u")
        .where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    low = stage(links.groupBy("u").agg(F.min("v").alias("m")), "star-min")
    moved = links.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` for every node that has a link; the component is its smallest node.

    ``links`` has two columns of integers. Alternating large-star and small-star
    steps: each is a minimum per node and a join, with linear output, so a hub of
    any degree is pre-aggregated before its rows are shuffled. Links of a node to
    itself, repeated links and links with a null end are ignored.
    """
    a, b = (F.col(c).cast("long") for c in links.columns[:2])
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), a.alias("a"), b.alias("b"))
    links = links.where("a is not null and b is not null and u != v").select("u", "v")
    links = stage(links.distinct(), f"{label}-links")
    before = _signature(links)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        links = stage(_small_star(stage(_large_star(links), f"{label}-large")), f"{label}-small")
        after = _signature(links)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # Now every link goes from a node to the smallest node of its component.
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
