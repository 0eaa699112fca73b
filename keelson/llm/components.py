"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), where root is the least node of its component.

    Alternates two steps until nothing changes: every node's larger neighbours link to its least neighbour, then its
    smaller neighbours do. A link is never split from its component and the number of links does not rise; trees
    flatten to stars in a logarithmic number of rounds. Each round is written to the shared folder.
    """
    edge = lambda x, y: [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]
    now = staged(links.filter("a <> b").select(*edge("a", "b")).distinct(), "links")
    state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while state[0]:
        # Large star: both ends see the link; neighbours above the node move to the least of all (the node included).
        both = now.select(F.col("a").alias("n"), F.col("b").alias("m")).union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("n").agg(F.min("m").alias("m")).select("n", F.least("n", "m").alias("least"))
        large = both.filter("m > n").join(least, "n").select(F.col("m").alias("a"), F.col("least").alias("b")).distinct()
        large = staged(large, "links-large")
        # Small star: the neighbours below the node, and the node itself, move to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        now = staged(small.filter("a <> b").distinct(), "links-small")
        after = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == state:
            break
        state = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
