"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import dropped, stored


def stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(lowest, "u")
    small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(joined.select("u", F.col("m").alias("v"))).distinct()


def digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every linked node, as a stored table; the label is the smallest node it reaches.

    Links may repeat and point either way; a link of a node to itself and a link with a
    null end say nothing.  Steps are logarithmic in the longest path; each result is written
    to the shared folder, so a lost executor costs one step at most.
    """
    edges = links.where(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "edges")
    seen = digest(edges)
    while seen[0]:
        after = stored(stars(edges), "edges")
        dropped(edges)
        edges, before, seen = after, seen, digest(after)
        if before == seen:
            break
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    labels = stored(nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()), "labels")
    dropped(edges)
    return labels
