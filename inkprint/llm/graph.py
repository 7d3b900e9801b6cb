"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkprint.session import materialize


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every node of an edge, the smallest node reachable from it.

    Alternates large and small stars: every node sends its larger, then its smaller neighbours to the smallest node
    it knows. A round is two aggregations and two joins over the edges, whose number never grows; the
    rounds grow with the logarithm of the longest path. Each round is a table in the shared folder. Null
    ends and loops are ignored; a graph without edges has no rows.
    """
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")) \
        .union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
