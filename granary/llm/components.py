"""Connected components of a large set of links by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.shared_store import settle


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("u")),
                                          F.struct(F.col("b").alias("v"), F.col("a").alias("u")))).alias("_e")).select("_e.v", "_e.u")


def _towards_least(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang neighbours on the least vertex of each neighbourhood: the larger ones, or all smaller ones and
    the vertex itself. Minima are combined before they are shuffled; the join can be split on hot vertices."""
    if not larger:
        edges = edges.where("u < v")
    least = edges.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), F.least("v", "m").alias("m"))
    met = edges.join(least, edges["v"] == least["w"])
    if larger:
        hung = met.where("u > v").select(F.col("m").alias("a"), F.col("u").alias("b"))
    else:
        hung = met.select(F.col("m").alias("a"), F.col("u").alias("b")).unionByName(least.select(F.col("m").alias("a"), F.col("w").alias("b")))
    return hung.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(vertex, component): the least vertex reachable, for every vertex with a link to another.

    ``links`` has the columns a and b (long); direction, repetition and loops don't matter, NULL ends are
    ignored. Each round is settled in the shared folder; the number of rounds grows with the logarithm of
    the longest path. No links give no rows.
    """
    edges = settle(links.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not now["n"] or (now["n"], now["h"]) == mark:
            return edges.select(F.col("b").alias("vertex"), F.col("a").alias("component")).unionByName(
                edges.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct())
        mark = (now["n"], now["h"])
        large = _towards_least(_both_ways(edges), True)
        edges = settle(_towards_least(large.select(F.col("b").alias("v"), F.col("a").alias("u")), False))
