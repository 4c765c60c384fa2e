"""Connected components of a graph that is given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.session import keep

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Large and small stars in turn: every node is hung to the smallest of its neighbours, first
    its larger neighbours, then itself with its smaller ones. The links of a node are never
    gathered: the smallest neighbour is an aggregate, merged on the map side and stored, and
    joining it back is a join of two plain tables that Spark may split at a node with very many links. The rounds are logarithmic in a
    component's width; each is stored, so that no lineage builds up.
    """
    edges = keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(),
        "edges",
    )
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        edges = keep(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node to the smallest of all its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    joined = both.where("v > u").join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours to the smallest of these."""
    least = keep(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.unionByName(own).where("u > v").distinct()
