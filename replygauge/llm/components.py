"""Connected components of a table of links, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replygauge.llm.common import discard, written


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id reachable.

    In each round every node is replaced by its neighbour (or itself) that comes
    first in a hashed order that changes from round to round; links inside of one
    node go. Paths shrink by a constant share in expectation, stars at once, so the
    number of rounds grows with the logarithm of the links. Links, nodes and rounds
    are tables of the shared work folder; those of a round go when the next is
    written. Ids are not null.
    """
    edges = written(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    place = written(nodes.withColumn("at", F.col("id")), "places")
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        first = F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("to"))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("to"))
        moved = both.groupBy("a").agg(F.least(F.min(first), F.min(own))["to"].alias("to"))
        moved = written(moved.select(F.col("a").alias("old"), "to"), "moves")
        ends = (
            edges.join(moved, edges.a == moved.old).select(F.col("to").alias("a"), "b")
            .join(moved, F.col("b") == moved.old).select("a", F.col("to").alias("b"))
        )
        ordered = ends.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        spent = [edges, place, moved]
        edges = written(ordered.distinct(), "links")
        place = written(place.join(moved, place["at"] == moved["old"], "left").select("id", F.coalesce("to", "at").alias("at")), "places")
        discard(*spent)
        turn += 1
    least = place.groupBy("at").agg(F.min("id").alias("component"))
    return place.join(least, "at").select("id", "component")
