"""Connected components of a graph given by its links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import staged


def _minima(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with the least of u and all its v. The minimum combines before the
    shuffle, and the join is one that Spark can split for a node with very many links."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").withColumn("m", F.least("m", "u"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): root is the component's least node.

    Alternates two steps until nothing changes: every node links its larger neighbours to its
    least neighbour, then its smaller ones. The number of rounds grows as the logarithm of
    the longest chain.
    """
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs, before = staged(ordered.where("u <> v").distinct(), "links"), None
    while True:
        state = pairs.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))
        ).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _minima(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _minima(large)
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = staged(small.where("u <> v").distinct(), "links")
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
