"""Connected components by alternating stars, on distributed edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import erase, written


ALONE = 100_000  # edges that one task takes without any exchange: some 10 MB


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of each end of an edge (a, b); label is the smallest node of its component.

    Large stars hook each neighbour that is larger than a node to the node's
    smallest neighbour, small stars the smaller ones; both keep connectivity,
    and in a logarithmic number of turns only stars are left. Each turn joins
    edges with the minima of their ends, which are aggregated before the
    exchange and written, so a join deals a hot node's edges out again where
    there are many, and no neighbour list is ever gathered. Up to ALONE edges
    the same steps run in one task, as their exchanges would cost more than they.
    """
    at = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    few = at.count() <= ALONE
    spent, seen = [at], None
    at = at.coalesce(1) if few else at

    def step(df: DataFrame) -> DataFrame:
        """A table for the next step: in one task as it is, else written."""
        if few:
            return df
        spent.append(written(df))
        return spent[-1]

    while True:
        state = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = at.unionByName(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = both.coalesce(1) if few else both
        low = step(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = step(large.distinct())
        least = step(down.groupBy("u").agg(F.min("v").alias("m")))
        hooked = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hooked = hooked.unionByName(least.select("u", F.col("m").alias("v")))
        after = written((hooked.coalesce(1) if few else hooked).distinct())
        erase(*spent)
        spent, at = [after], after.coalesce(1) if few else after
    ends = at.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return written(ends.unionByName(at.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))
