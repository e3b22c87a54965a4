"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scratch import stored


#: Edges of a round for which there is a task and a file.
EDGES_A_FILE = 100_000


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Of every node, the neighbours above it get the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Of every node, the neighbours below it and itself get the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a long, b long): the least node reachable.

    Links may repeat, point either way or to their own node; a link with a null end is none. Each round is
    written to the shared folder. Only a count and a checksum of a round reach the driver.
    """
    links = links.where("a is not null and b is not null")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        # as many files as the edges need: a round of few edges in many files is all overhead
        edges = stored(_small_star(_large_star(edges)).coalesce(before[0] // EDGES_A_FILE + 1), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    return nodes.join(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
