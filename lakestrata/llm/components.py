"""Connected components of a link table, by contraction, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Each round hooks every node to its smallest neighbour, jumps one hook further and replaces
    the links by those between hooks. The smallest node of a component always hooks to
    itself, so it is what remains. Rounds grow with the logarithm of the longest chain, and links
    shrink in each. A node with a third of all links costs one row per task: neighbours are
    reduced by a minimum before the shuffle. Links with a null end and loops are left out.
    """
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").distinct()
    edges = materialize(edges, "links")
    nodes = None
    while not edges.isEmpty():
        both = edges.union(edges.select("y", "x"))
        hooks = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least"))
        hooks = materialize(hooks.select("node", F.least("node", "least").alias("hook")), "hooks")
        further = hooks.select(F.col("node").alias("hook"), F.col("hook").alias("next"))
        hooks = materialize(hooks.join(further, "hook").select("node", F.col("next").alias("hook")), "hooks")
        if nodes is None:
            nodes = hooks.withColumnRenamed("hook", "component")
        else:
            moved = hooks.select(F.col("node").alias("component"), "hook")
            nodes = nodes.join(moved, "component", "left").select(
                "node", F.coalesce("hook", "component").alias("component")
            )
            nodes = materialize(nodes, "components")
        left = hooks.select(F.col("node").alias("x"), F.col("hook").alias("hx"))
        right = hooks.select(F.col("node").alias("y"), F.col("hook").alias("hy"))
        edges = edges.join(left, "x").join(right, "y").where("hx <> hy")
        edges = materialize(edges.select(F.col("hx").alias("x"), F.col("hy").alias("y")).distinct(), "links")
    if nodes is None:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("component"))
    return nodes
