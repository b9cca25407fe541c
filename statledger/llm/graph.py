"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import folder, stored


def _stars(links: DataFrame) -> bool:
    """Whether every node of the distinct ``links`` (``x`` hangs on ``y``) hangs on one other at most, and none hangs on it then."""
    roles = links.select(F.col("x").alias("v"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(links.select("y", F.lit(0), F.lit(1)))
    most = roles.groupBy("v").agg((F.sum("hangs") + F.max("holds")).alias("roles")).agg(F.max("roles")).first()[0]
    return most is None or most <= 1


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (long columns ``a``, ``b``): columns ``node``, ``component``.

    Each round hangs the larger neighbours of a node on its smallest neighbour and then the smaller ones, so the
    graph turns into stars in a number of rounds that grows with the logarithm of its size. Nothing but one
    number per round reaches the driver. Rounds are written to the shared folder. Self links and nulls are left out;
    a smallest node carries itself.
    """
    where, turn = folder(edges.sparkSession), 0
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct()
    now = stored(now, "stars0", where)
    while not _stars(now):
        turn += 1
        both = now.select(F.col("x").alias("v"), F.col("y").alias("u")).union(now.select("y", "x"))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("x"), F.col("m").alias("y")).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").where("y > m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        now = stored(small.union(least).where("x <> y").distinct(), f"stars{turn}", where)
    return now.select(F.col("x").alias("node"), F.col("y").alias("component")).union(now.select("y", "y").distinct())
