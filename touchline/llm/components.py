"""Connected components of a graph given by its links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link; root is the smallest node reachable.

    Alternating stars: first every node hands the smallest of its neighbours and
    itself to its larger neighbours, then to its smaller ones and itself, until
    nothing changes; the links then are the answer. Only sums per node are
    aggregated, never lists of neighbours, so a node with very many links costs
    one row per link. Each round reads and writes a table in the shared folder.
    """
    spark = links.sparkSession
    links = written(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = written(_star(both, F.col("b") > F.col("a"), own=False), "large-star")
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links = written(_star(down, F.lit(True), own=True), "small-star")
        before, state = state, links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return spark.createDataFrame([], links.schema).toDF("node", "root") if not state[0] else links.toDF(
                "node", "root"
            )


def _star(links: DataFrame, kept, own: bool) -> DataFrame:
    """Links (neighbour, smallest) of the neighbours of ``a`` that ``kept`` selects, and of ``a`` itself if ``own``."""
    smallest = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = links.where(kept).join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if own:
        moved = moved.unionByName(smallest.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()
