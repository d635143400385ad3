"""Connected components of a distributed edge table (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b``); root is the smallest node reached.

    Each round hooks larger neighbours to the smallest one (large star) and
    then the smaller ones together (small star); the rounds needed grow with
    the logarithm of the longest chain.  Each round is written to the shared
    folder; nothing but a count and a checksum comes to the driver.  A centre
    of very many pairs is split by the engine's skew join, whose other side
    has one row for it.
    """
    least, most = F.least("a", "b"), F.greatest("a", "b")
    pairs = common.materialise(edges.where("a <> b").select(most.alias("a"), least.alias("b")).distinct(), "edges")
    total, seen = pairs.count(), None
    while total:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        down = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        m = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(m, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        pairs = common.materialise(small.where("a <> b").distinct(), "edges")
        sums = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(sums) == seen:
            break
        total, seen = sums[0], tuple(sums)
    return pairs.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
