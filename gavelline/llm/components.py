"""Connected components of a sparse graph given as pairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.session import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): the smallest node that can be reached.

    Large-star and small-star steps in turn: a node hooks its larger neighbours, then its smaller ones, to the smallest node
    it sees.  Neighbours are never listed; only minima are aggregated, before the shuffle as well.  Each round is written
    out, and the number of pairs never grows.  Ends when a round changes nothing.
    """
    pairs = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs, state = cut(pairs), None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(least, "a").filter("b > a").select(F.col("low").alias("a"), "b").filter("a <> b").distinct()
        large = cut(large)
        low = large.groupBy("b").agg(F.min("a").alias("low"))
        joined = large.join(low, "b")
        hooks = joined.select("low", F.explode(F.array("a", "b")).alias("node")).filter("low <> node")
        pairs = cut(hooks.select(F.col("low").alias("a"), F.col("node").alias("b")).distinct())
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now
