"""Connected components of a table of links, as rounds of joins over stored tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.sources.storage import written


def _lowest(links: DataFrame) -> DataFrame:
    """For each node ``u`` the lowest of itself and its neighbours ``v``.

    The key is an expression, not the column the groups were made by, so that the join after it has a
    shuffle on either side and Spark can split a node that has very many links.
    """
    lows = links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    return lows.select((F.col("u") + F.lit(0)).alias("node"), "low")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node that has a link, with the lowest node it can reach.

    Links are two columns of whole numbers, in either direction, repeated or not; links with null are left
    out. Each round hangs a node's higher neighbours, then the node and its lower ones, under the lowest
    neighbour (the large-star and small-star steps of Kiveris and others, 2014), and it ends when every node either hangs
    once or has nodes hung under it. Rounds grow with the logarithm of the number of nodes. Every round is a stored table.
    """
    one, other = F.greatest(a, b).cast("long"), F.least(a, b).cast("long")
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    tree = written(links.select(one.alias("u"), other.alias("v")).distinct(), "components")
    while True:
        ends = tree.select(F.col("u").alias("node"), F.lit(1).alias("hangs")).union(tree.select("v", F.lit(0)))
        places = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.count(F.lit(1)).alias("links"))
        if not places.filter("hangs > 0 AND links > 1").count():
            return tree.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                tree.select("v", "v").distinct()
            )
        both = tree.union(tree.select("v", "u"))
        large = both.join(_lowest(both), F.col("u") == F.col("node"))
        large = large.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = large.join(_lowest(large), F.col("u") == F.col("node"))
        hung = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("low").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                )
            ).alias("link")
        ).select("link.u", "link.v")
        tree = written(hung.filter("u <> v").distinct(), "components")
