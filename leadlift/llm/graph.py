"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlift.llm.common import scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every end of an edge (a, b); comp is the least node reachable.

    Each round hangs neighbours on the least node around, first the larger ones, then
    the smaller; the edges left in the end are one star per component. Tables are
    written between rounds, so a hub's rows meet a plain exchange and can be split.
    """
    low, high = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    now = scratch(edges.filter("a != b").select(high, low).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch(large.filter("u != v").distinct(), "edges")
        least = scratch(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionAll(least.select("u", F.col("m").alias("v")))
        now = scratch(small.filter("u != v").distinct(), "edges")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(roots)
