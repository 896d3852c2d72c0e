"""Connected components of a link table, wholly in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(v, component) for every vertex of links (a, b): the smallest vertex it can reach.

    Alternates two steps until only stars are left: every vertex hands its larger neighbours to its
    smallest one, then its smaller neighbours to the smallest of them. Both keep components and
    shrink paths by a constant factor, so rounds grow with the logarithm of a path's length.
    A vertex with very many neighbours is a partly aggregated minimum and a join that adaptive
    execution splits; nothing collects its neighbours."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), f"{name}-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))
        edges = stored(large.join(smallest, "u").select(F.explode(ends).alias("e")).select("e.u", F.col("e.m").alias("v"))
                       .where("u <> v").distinct(), f"{name}-edges")
        # done when every vertex has one parent and no parent has one itself
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        left = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        if not left.limit(1).count():
            break
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("v"), F.col("v").alias("component"))


def joined(labels: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """`labels` (v, component) after further links (a, b) between labelled vertices: only the
    components that a link joins are worked on."""
    ends = (links.join(labels.select(F.col("v").alias("a"), F.col("component").alias("ca")), "a")
            .join(labels.select(F.col("v").alias("b"), F.col("component").alias("cb")), "b"))
    over = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")), name)
    renamed = over.select(F.col("v").alias("component"), F.col("component").alias("to"))
    return stored(labels.join(renamed, "component", "left").select("v", F.coalesce("to", "component").alias("component")),
                  f"{name}-labels")
