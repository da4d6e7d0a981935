"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.storage import written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` with the least node of each component as its label.

    Large-star / small-star contraction: every round hangs nodes onto the least neighbour they
    know, so chains shrink by halves and a round costs one shuffle of the remaining edges. The
    edge table is written to the shared folder each round. Edges with a null end and self-loops
    are ignored; an empty table gives no rows. Any orderable type can be a node.
    """
    e = (
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = written(e, "edges")
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: neighbours above u hang onto u's least neighbour (or u itself)
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        # small star: u and its lesser neighbours hang onto the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v")
            .where("u <> v")
            .distinct()
        )
        new = written(small, "edges")
        # settled when every edge is a star's: no leaf has two centres or is itself a centre
        ends = new.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
            new.select("v", F.lit(0), F.lit(1))
        )
        tally = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
        settled = tally.where("leaf > 1 or (leaf = 1 and centre = 1)").isEmpty()
        e = new
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
