"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverlake.llm.text import materialise


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours linked to the smallest of them: only larger neighbours, or only smaller ones."""
    if larger:
        sides = edges.union(edges.selectExpr("b AS a", "a AS b"))
    else:
        sides = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = sides.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a AS node", "least(a, low) AS low")
    joined = sides.join(least, sides.a == least.node)
    if larger:
        return joined.where("b > a").selectExpr("b AS a", "low AS b").distinct()
    return joined.selectExpr("b AS a", "low AS b").union(least.selectExpr("node AS a", "low AS b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest node of each node's component: node, root, for the nodes of `edges` (a, b).

    Large and small stars alternate until every node hangs on its component's smallest one, which takes a number of
    rounds that grows with the logarithm of the nodes. Every round is written to the shared folder; the driver only
    sees a count and a checksum. Nodes may be of any type that has an order; null nodes and loops are left out.
    """
    now = materialise(edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.expr("sum(CAST(xxhash64(a, b) AS DECIMAL(20, 0)))")).first()
        if mark == seen or not mark[0]:
            return now.selectExpr("a AS node", "b AS root").union(now.selectExpr("b AS node", "b AS root").distinct())
        seen = mark
        now = materialise(_stars(_stars(now, True), False), "stars")
