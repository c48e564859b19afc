"""Connected components of a sparse link table by alternating star contractions.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014):
a large-star step links every larger neighbour of a node to the node's smallest
neighbour, a small-star step does the same for the smaller ones.  A round never
adds links; the result is one star per component.  Each round is two joins
whose hot keys adaptive execution splits; nothing is gathered per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return (pairs.join(least, "u")
            .withColumn("m", F.least("u", "m")))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    met = _with_least(down)
    moved = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = met.select("u", F.col("m").alias("v"))
    return moved.union(kept).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) -> (node, root): root is the least node that node reaches.
    Nodes without a link, self links and repeated links are allowed; a node
    that only has self links gets no row."""
    links = cut(links.filter("u != v").select("u", "v").distinct())
    mark = F.struct(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).alias("s")
    seen = links.agg(mark).first().s
    while seen.n:
        links = cut(_small_star(_large_star(links)))
        now = links.agg(mark).first().s
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
