"""Connected components of a membership relation, for any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from refmine.operators.skew import HOT_PARTS, hot_key_join
from refmine.session import materialize


def components(members: DataFrame, node: str, link: str, alone: bool = True, max_rounds: int = 60) -> DataFrame:
    """(node, component): nodes that share a link value, directly or through others, share a component.

    The component is its smallest node. ``node`` and ``link`` may be of any orderable types;
    rows with a null in either connect nothing and give no row; repeated rows don't matter;
    an empty input gives an empty result. ``alone``: whether nodes of a component of their
    own come out too.

    A link value of many nodes becomes a star around its smallest node, not pairs. Then
    alternating rounds of large-star and small-star steps halve the paths; each round is
    written to the shared folder, so that plans stay short and a lost executor costs one
    round, and counted and fingerprinted as it is written. Neighbourhoods are never
    collected: a node's smallest neighbour is an aggregate with map-side combine, which also
    tells the hot nodes, and it goes back to the edges by a join that treats these apart.
    (In the small step a node's edges lead to smaller nodes only, of which large stars leave
    few, and nodes with one edge skip the join.)
    """
    pairs, told = _written(members.select(F.col(node).alias("u"), F.col(link).alias("f")).where("u IS NOT NULL AND f IS NOT NULL").distinct(), "cc-pairs", "u", "f")
    stars = pairs.groupBy("f").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("n"))
    edges = hot_key_join(pairs, stars.select("f", "v"), ["f"], hot=_hot(stars, "f", told[0])).where("u <> v").select("u", "v").distinct()
    edges, before = _written(edges, "cc-edges", "u", "v")
    for _ in range(max_rounds):
        if not before[0]:
            break
        # Large star: each larger neighbour of u is tied to u's smallest neighbour (or u).
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # u's neighbours above u
        tied = hot_key_join(larger, low.select("u", F.least("u", "m").alias("m")), ["u"], hot=_hot(low, "u", before[0]))
        large = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        tied = large.join(low.where("n > 1").select("u", "m"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, after = _written(tied.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges", "u", "v")
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled edges are stars: every node but a component's smallest has one edge to it.
    own = pairs.select("u", F.col("u").alias("v")) if alone else edges.select(F.col("v").alias("u"), "v")
    return edges.unionByName(own).groupBy(F.col("u").alias(node)).agg(F.min("v").alias("component"))


def _hot(counted: DataFrame, key: str, rows: int) -> DataFrame:
    """The keys with more than 1/HOT_PARTS of so many rows, of a table with their counts ``n``."""
    return counted.where(F.col("n") > rows // HOT_PARTS).select(key)


def _written(df: DataFrame, label: str, *columns: str) -> tuple[DataFrame, tuple]:
    """The table, written, with its count and an order-free hash: equal for equal sets of rows."""
    told = Observation()
    seen = df.observe(told, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h"))
    written = materialize(seen, label)
    return written, (told.get["n"], told.get["h"])
