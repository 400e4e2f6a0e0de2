"""Connected components of a link table, by alternating large and small stars.

Every round only joins and takes minima per node, so no component is ever gathered; a hub
with very many neighbours is pre-aggregated on the map side, and its rows in a join are
split by AQE. The rounds needed grow with the logarithm of the nodes. Each round's links are
written, so that a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import stage


def _done(links: DataFrame) -> bool:
    """Whether every node has one root, and no root is a node."""
    ends = links.select(F.explode(F.array(F.struct(F.col("node").alias("x"), F.lit(1).alias("n")), F.struct(F.col("root").alias("x"), F.lit(0).alias("n"))))).select("col.*")
    seen = ends.groupBy("x").agg(F.sum("n").alias("links"), F.min("n").alias("least"))
    return seen.filter((F.col("links") > 1) | ((F.col("links") == 1) & (F.col("least") == 0))).isEmpty()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, root)`` for every node that is not the least of its component.

    ``links`` has pairs ``node, root`` of any one orderable type; null and equal pairs are no
    links. An empty table gives an empty one.
    """
    links = links.filter(F.col("node") != F.col("root")).select("node", "root").distinct()
    links = stage(links, name)
    while not _done(links):
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        large = both.filter(F.col("root") > F.col("node")).join(least, "node")
        large = large.select(F.col("root").alias("node"), F.col("least").alias("root")).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node")
        small = (
            small.filter(F.col("root") != F.col("least"))
            .select(F.col("root").alias("node"), F.col("least").alias("root"))
            .unionByName(least.withColumnRenamed("least", "root"))
            .distinct()
        )
        links = stage(small, name)
    return links
