"""Connected components of a link table by alternating star contraction.

Each round points every vertex at the smallest vertex it knows (large star: larger neighbours; small
star: smaller ones) until the links are stars around the smallest vertex of each component. Rounds are
written to the shared folder; the number of rounds grows with the logarithm of the longest chain.
Counts reach the driver, links never do. The neighbours of a hub are aggregated map-side, and the joins
back to them can be split by Spark where a hub is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.where("b < a") if not large else both
    low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    side = both.where("b > a") if large else near
    out = side.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(low.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex that has a link; ``links`` has columns a, b."""
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "links")
    state = None
    while True:
        now = written(_star(_star(now, large=True), large=False), "stars")
        # a fixed point has the same links; order-free fingerprint of the whole table
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == state:
            break
        state = tuple(mark)
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
