"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.base import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Every node sends its larger neighbours to the smallest node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node sends its smaller neighbours, and itself, to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b: long), itself included.

    Links may come in either direction and repeat; loops and links with a null are left out. Nodes without a link to
    another node are not in the result. Each round halves the paths or better; it aggregates before it joins, so a
    node with very many links costs one row per task in the shuffle of its minimum, and its links can be split.
    Links stay in tables throughout; the driver sees two numbers a round.
    """
    now = settle(links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b").distinct(), "links", narrow=True)
    seen = None
    while True:
        # Bounded: one row. The same links again mean that every node hangs on its root.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = tuple(state)
        now = settle(_small_star(_large_star(now)), "links", narrow=True)
