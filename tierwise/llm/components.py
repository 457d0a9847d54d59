"""Connected components of a graph by alternating stars.

A large star gives every greater neighbour of a node the node's smallest neighbour, a small star
every lesser one; when nothing changes, each node is linked to the smallest node of its component
only.  Smallest neighbours are aggregated before they are joined back, so that a node with very
many links is never gathered in one task; a round's links are written to the shared folder and
deleted after the next one, and the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import written_to
from tierwise.scratch import delete, work_dir


def large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").filter("v <> m").selectExpr("v u", "m v").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """``links`` have the greater node first."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").filter("v <> m").selectExpr("v u", "m v")
    return others.union(least.selectExpr("u", "m v")).distinct()


def state(links: DataFrame) -> tuple:
    return tuple(links.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of each node that has a link to another; ``links`` are the columns u and v.

    The root is the smallest node that can be reached.  Links of a node to itself, repeated ones and
    those without a node say nothing.
    """
    clean = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    spark, place = links.sparkSession, work_dir(links.sparkSession, "links")
    now = written_to(clean.distinct(), place)
    before, after = None, state(now)
    while before != after:
        spent, place = place, work_dir(spark, "links")
        now = written_to(small_star(large_star(now)), place, rows=after[0])
        before, after = after, state(now)
        delete(spark, spent)
    return now.selectExpr("u node", "v root").union(now.selectExpr("v node", "v root").distinct())
