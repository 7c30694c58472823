"""Connected components of links between 64-bit node ids.

Rounds of: every node takes its least neighbour as parent (a map-side
combined minimum, so a hub is one row per task), parents are followed to
their roots by pointer jumping, links are redrawn between roots.  Each round
at least halves the nodes that still have links.  Links, parents and labels
stay in Spark; only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stored import stored


def _through(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` replaced by its parent, where it has one."""
    p = parents.select(F.col("node").alias("__node"), F.col("parent").alias("__parent"))
    return (df.join(p, df[column] == p["__node"], "left")
            .withColumn(column, F.coalesce("__parent", column)).drop("__node", "__parent"))


def _roots(parents: DataFrame) -> DataFrame:
    """Every node's root: parents of parents until nothing changes."""
    while True:
        jumped = stored(_through(parents.withColumn("was", F.col("parent")), "parent", parents))
        parents = jumped.select("node", "parent")
        if jumped.filter("parent <> was").isEmpty():
            return parents


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (src, dst: long);
    component is the least node reachable."""
    def clean(df):
        return stored(df.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                      .distinct())

    links = clean(links)
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = stored(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m"))
                       .select("node", F.least("node", "m").alias("parent")))
        roots = _roots(least)
        if labels is None:
            labels = roots.withColumnRenamed("parent", "component")
        else:
            labels = stored(_through(labels, "component", roots))
        links = clean(_through(_through(links, "src", roots), "dst", roots))
    if labels is None:
        return links.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    return labels
