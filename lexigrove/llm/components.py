"""Connected components of a link table by alternating star steps.

Each step replaces a node's links by links to the smallest node it knows (large star: from its larger neighbours, small
star: from its smaller ones), until a star around the smallest node is left of each component. Both need one minimum
per node, combined before the shuffle, and one join. Minima are stored first, so the join has a plain exchange on either
side and the links of a node that many others point to can be split. No node, link or component reaches the driver.

Empty links give an empty result; repeated links, reversed links and links to itself change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexigrove.plans.runtime import materialize


def _with_minimum(directed: DataFrame) -> DataFrame:
    """``(u, v, m)``: ``m`` is the smallest of ``u`` and all its ``v``."""
    minima = materialize(directed.groupBy("u").agg(F.min("v").alias("m")))
    return directed.join(minima, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    near = _with_minimum(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    moved = near.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v"))).filter("u <> v")


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has two columns of node numbers; returns ``(node, root)`` of all linked nodes, root the smallest.

    Runs jobs when called; tables go to the shared checkpoint folder.
    """
    left, right = links.columns[:2]
    current = materialize(links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v").distinct())

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(current)
    while before[0]:
        current = materialize(_small_star(_large_star(current).distinct()).distinct())
        after = mark(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
