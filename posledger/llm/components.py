"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from posledger.sources.tables import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node that can be reached.

    ``links`` has two columns of one ordered type. Each round is written to the shared folder, so lineage
    stays one round long. A star of any size is one row per member, and the joins are plain ones that
    adaptive execution can split, so a large component needs no task of its own. A node that is a root has
    no row. Self-links and repeated links do nothing; no links give no rows.
    """
    links = links.toDF("a", "b").where("a <> b")
    links = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        links = stage(_small_star(_large_star(links)), "links")
