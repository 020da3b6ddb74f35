"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.session import cut_lineage

#: Links that one task of a round should hold; the number of tasks follows the number of links.
TASK_LINKS = 250_000


def _open(edges: DataFrame) -> tuple[int, int]:
    """The number of links, and of nodes that point to several nodes or are pointed to as well; without one all are stars."""
    ends = F.array(*[F.struct(F.col(c).alias("n"), F.lit(k).alias("up")) for c, k in (("a", 1), ("b", 0))])
    nodes = edges.select(F.inline(ends)).groupBy("n").agg(F.sum("up").alias("up"), F.count("*").alias("all"))
    row = nodes.agg(F.sum("up"), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("all") > F.col("up"))))).first()
    return row[0] or 0, row[1]


def _ends(edges: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """``a, b`` of several pairs of columns of each row, without self links."""
    every = F.array(*[F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs])
    return edges.select(F.explode(every).alias("e")).select("e.a", "e.b").filter("a != b")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``); the component is its smallest node.

    Self links and repeated links are harmless; rows with a null end are left out.  Each round points nodes at the
    smallest neighbour; the number of rounds grows with the logarithm of the longest chain, and links that are stars
    of their smallest nodes need none.  No task holds a
    component: minima are partial aggregates and the joins are plain equi-joins that adaptive execution can split.
    """
    edges = cut_lineage(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n, unsettled = _open(edges)
    while unsettled:
        tasks = -(-n // TASK_LINKS)  # a round keeps at most two rows of each link
        both = _ends(edges.coalesce(tasks), ("a", "b"), ("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["n"]).filter("b > a AND b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.coalesce(tasks)
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        pointed = large.join(low, large["a"] == low["n"])
        edges = cut_lineage(_ends(pointed.coalesce(tasks), ("b", "m"), ("a", "m")).distinct().coalesce(tasks))
        n, unsettled = _open(edges)
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(roots)
