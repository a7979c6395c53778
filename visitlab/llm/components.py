"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


#: Parts into which the neighbours of one id are dealt.
PARTS = 64


def _least_of_each(edges: DataFrame) -> DataFrame:
    """``edges`` with m, the least v of their u. Minima are taken by (u, part of
    v) first and brought back the same way, so that no task reads all the edges of
    a hub: at most ``PARTS`` rows of it meet in one."""
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    parts = dealt.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return dealt.join(parts.select("u", "part").join(least, "u"), ["u", "part"]).drop("part")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u points to the least of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least_of_each(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours point to the least of them (u > v in every edge)."""
    known = _least_of_each(edges)
    return known.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``links`` that is not the least of its
    component; component is the least id reachable. Loops and null ends are
    dropped, repeated links count once. The edge table never grows, a round
    moves it twice, and the number of rounds is logarithmic in the data."""
    edges = (links.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = materialize(edges, "edges")
    seen = _digest(edges)
    while seen[0]:
        edges = materialize(_small_star(materialize(_large_star(edges), "large-star")).distinct(), "edges")
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
