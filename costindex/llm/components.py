"""Connected components of a link table, as Spark joins (alternating large-star and small-star).

Every round rewrites the links so that nodes point at smaller nodes.  Rounds are
written to the shared folder, so a lost executor costs a re-read.  Nothing but
two numbers a round (row count and a checksum) reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import stage


def _linked_to_least(links: DataFrame) -> DataFrame:
    """For links (u, v): every link with ``m``, the least node that u is linked with.

    The minima are stored first, so the join has two plain inputs and a node
    with very many links is split between tasks.
    """
    least = stage(links.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    return links.join(least, "u")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``: the least node reachable.

    Loops and repeated links are ignored; rows with a null end are ignored.  An
    empty table gives an empty one.
    """
    links = stage(
        edges.filter(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components-links")

    def mark(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(links)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_linked_to_least(both).filter("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        large = stage(large, "components-large")
        near = _linked_to_least(large)
        small = (near.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(near.select("u", F.col("m").alias("v"))).distinct())
        links = stage(small, "components-links")
        now = mark(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("links did not settle")
    roots = links.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
