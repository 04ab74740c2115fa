"""Connected components of a link table by alternating star contraction.

Every round is a fixed number of keyed aggregations and joins; nothing is
collected but one checksum row, and each round's links are written to the
shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to its smallest neighbour (or itself)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # stored, so that the join reads both sides from a shuffle and a node with very many links can be split
    low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("m")), "lowest")
    return (both.join(low, both.u == low.k).where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    low = stored(links.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")), "lowest")
    moved = links.join(low, links.u == low.k).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = low.select(F.col("k").alias("u"), F.col("m").alias("v"))
    return moved.union(own).where("u > v").distinct()


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node with a link; root is the smallest node it reaches.

    Repeated links, links in both directions and self-links are allowed; an
    empty table gives an empty result. Rounds end when the star table no
    longer changes, which takes a number of rounds logarithmic in the size of
    the largest component.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    links = stored(links, "links")
    state = _state(links)
    while True:
        links = stored(_small_star(stored(_large_star(links), "links-large")), "links-small")
        now = _state(links)
        if now == state:
            break
        state = now
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
