"""Connected components of a table of links, by alternating star steps.

Each step points nodes at the smallest neighbour they know (large star: the
larger neighbours, small star: the others); the links settle into one star per
component, led by its smallest node: every node is a leader or has one link.
Up to HOT links, no node can have more than that, so windows over a node's links
do, two shuffles for both steps.  Beyond, links meet their nodes' least
neighbours by a join on the node, and a node of more than HOT links that has
over a thousandth of all (fewer than 2000 are such) meets its own by broadcast,
so no task gets all links of one.
All state is a table of links in the shared checkpoint folder; nothing but
numbers of rows reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.llm.common import narrowed, staged

#: Links of one node that a task may get.
HOT = 100_000


def _star(links: DataFrame, large: bool, total: int | None) -> DataFrame:
    """(u, v) with u > v -> the links after one star step, u > v again; with
    ``total``, their number, nodes of over a thousandth of them are joined by broadcast."""
    both = links if not large else links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
    if total is None:
        met = both.join(least.drop("n"), "u")
    else:
        hot = F.col("n") * 1000 > total
        few = F.broadcast(least.where(hot).drop("n"))
        met = both.join(few, "u").unionByName(both.join(few, "u", "left_anti").join(least.where(~hot).drop("n"), "u"))
    if large:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.where("u > v")


def _stars(links: DataFrame, total: int) -> DataFrame:
    """(u, v) with u > v, ``total`` of them -> the links after both star steps, and whether a step moved them."""
    least = F.min("v").over(Window.partitionBy("u"))
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (narrowed(both.withColumn("m", F.least("u", least)), 2 * total).where("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") < F.col("u")).alias("moved")))
    rows = large.repartition("u").groupBy("u", "v").agg(F.max("moved").alias("moved")).withColumn("m", least)
    other = F.col("v") != F.col("m")
    moved = rows.select(F.when(other, F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"), (other | F.col("moved")).alias("moved"))
    return narrowed(moved, total)


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(a, b) -> (node, component): the smallest node reachable, for every node but the smallest of
    each component.  ``most``: a bound of the number of links, if one is known."""
    own = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = staged(own if most is None else narrowed(own, most), "links")
    settled = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    total = now.count()
    while 0 < total <= HOT:
        now = staged(_stars(now, total), "links")
        settled = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now.agg(F.count(F.lit(1)).alias("total"), F.max("moved").alias("moved")).first()
        if not state["moved"]:
            return settled
        total = state["total"]
    return _settled_wide(now.select("u", "v")) if total else settled


def _settled_wide(now: DataFrame) -> DataFrame:
    """The same for links of any number."""
    while True:
        ends = now.select("u", F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
            now.select(F.col("v").alias("u"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        each = ends.groupBy("u").agg(F.sum("down").alias("down"), F.sum("up").alias("up"))
        state = each.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).alias("open"),
                         F.sum("down").alias("total"), F.max(F.col("down") + F.col("up")).alias("most")).first()
        if not state["open"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        total = state["total"] if state["most"] > HOT else None
        now = staged(_star(_star(now, True, total), False, total).distinct(), "links")
