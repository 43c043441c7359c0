"""Connected components of a link table, as joins and minima alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Links in one partition of the tables below; few links lie in few files, however many partitions they came from.
PART_LINKS = 100_000


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every end of a link; the component is its smallest id.

    Each round every id takes the smallest parent it sees over its links, its
    parent takes it too, and parents are replaced by their parents, so chains
    shorten by halves. Rounds end when no parent changes. Every step is a join
    on a key that is unique on one side, or a minimum that is pre-aggregated.
    """
    both = links.select(F.col(a).alias("v"), F.col(b).alias("w")).filter("v <> w")
    parts = 1 + 2 * both.count() // PART_LINKS

    def kept(df: DataFrame) -> DataFrame:
        return saved(df.coalesce(parts))

    edges = kept(both.unionByName(both.select(F.col("w").alias("v"), F.col("v").alias("w"))).distinct())
    parents = kept(edges.groupBy("v").agg(F.least(F.col("v"), F.min("w")).alias("f")))
    while True:
        up = parents.select(F.col("v").alias("f"), F.col("f").alias("g"))
        grand = kept(parents.join(up, "f").select("v", "f", "g"))
        seen = (edges.join(grand.select(F.col("v").alias("w"), "g"), "w").groupBy("v").agg(F.min("g").alias("m")))
        offers = grand.join(seen, "v").select(
            F.explode(F.array(F.struct("v", F.least("f", "g", "m").alias("f")), F.struct(F.col("f").alias("v"), F.col("m").alias("f")))).alias("o"))
        after = kept(offers.groupBy(F.col("o.v").alias("v")).agg(F.min("o.f").alias("f")))
        changed = after.join(parents.withColumnRenamed("f", "old"), "v").filter("f <> old").limit(1).count()
        parents = after
        if not changed:
            return parents.select(F.col("v").alias("id"), F.col("f").alias("component"))
