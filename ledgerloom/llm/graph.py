"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import freeing, kept, release


def round_of_stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b), a > b, as (a, b, moved).

    ``moved`` marks rows that come of a neighbourhood which was no star around its smallest node. Where
    none is marked, edges were stars already and come back once each.
    """
    both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    own = Window.partitionBy("a")
    large = both.withColumn("m", F.min("b").over(own)).where("b > a")
    large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b"), (F.col("m") < F.col("a")).alias("moved"))
    told = large.withColumns({"m": F.min("b").over(own), "before": F.lag("b").over(own.orderBy("b")), "moved": F.max("moved").over(own)})
    # A node's first row gives its own link, its other neighbours are linked to the smallest, each once.
    told = told.where(F.col("before").isNull() | (F.col("before") < F.col("b")))
    return told.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"), (F.col("moved") | (F.col("b") > F.col("m"))).alias("moved"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; label is the smallest node of its component.

    ``links`` has columns a and b. Large-star and small-star steps alternate until only stars are left:
    each turns every neighbourhood into a star around its smallest node, so the number of rounds
    grows with the logarithm of the longest chain. A round is two shuffles by node, in which a node's links
    are sorted and read one after the other. Null ends and links of a node to itself are ignored. Each
    round is cut off by a checkpoint.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    while True:
        edges = kept(round_of_stars(edges))
        release(links.sparkSession)
        with freeing(links.sparkSession):
            if edges.where("moved").isEmpty():
                break
    # Every edge now leads from a node to the smallest of its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b"), F.col("b")).distinct())
