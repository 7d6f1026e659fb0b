"""Connected components of a table of links, by alternating stars.

Every round makes two kinds of stars: a node's larger neighbours are linked to
the least node next to it, then its smaller neighbours and itself to the least
of them. No round has more links than the one before by more than a constant,
the number of rounds grows with the logarithm of the nodes, and each round is
a written table, so that lineage stays short. A node with very many links is
never gathered: its least neighbour is aggregated in each task first, and the
join that follows is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripengine.llm.common import materialise


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("m", "u"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u <> v")


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger to the smaller node."""
    moved = links.join(_least(links), "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .where("u <> v")
    kept = _least(links).select("u", F.col("m").alias("v"))
    return moved.unionByName(kept)


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node it can reach) for every node with a link.

    ``links`` has two columns of one ordered type; their order, repetitions and
    links of a node to itself do not matter.
    """
    a, b = links.columns
    now = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = materialise(now, "links")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if (mark.n, mark.h) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = mark.n, mark.h
        now = materialise(_small_star(_large_star(now).distinct()).distinct(), "links")
