"""Connected components of a table of links, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plateward.session import remove, scratch_path, stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least_neighbour(both).select("u", F.least("m", "u").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    joined = down.join(_least_neighbour(down), "u")
    # Both links of a row at once, so that the join is planned and run once; repeated ones go with distinct().
    ends = F.array(F.col("v"), F.col("u"))
    return joined.select(F.explode(ends).alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _print(edges: DataFrame) -> tuple:
    """Count and check sum of a set of edges."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least node, for every node with a link.

    ``links`` has ``a`` and ``b``. Alternating large and small stars end with
    every node linked to the least of its component, after about the square of
    the logarithm of the links' number of rounds at most. Each round is written
    and read again, so none depends on a lost executor.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    while (now := _print(edges)) != before:
        before = now
        # Each star is a job of its own: in one, the small star would plan the large one several times.
        path = scratch_path(edges.sparkSession, "large-star")
        large = stored(_large_star(edges), "large-star", path)
        edges = stored(_small_star(large), "links")
        remove(edges.sparkSession, path)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
