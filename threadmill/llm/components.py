"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from threadmill.session import in_few_tasks, materialize

#: Links that one task works on, 16 bytes each.
LINKS_PER_TASK = 200_000


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node of its component.

    Each round hangs a node's larger neighbours under its smallest one, then its smaller ones.
    The rounds grow with the logarithm of the component size, and a node of any degree is only
    ever reduced by a minimum. Rounds are kept in the shared folder. No links: no rows.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).where("u <> v").distinct()
    edges, before = _kept(edges)
    while True:
        def few(table: DataFrame) -> DataFrame:
            return in_few_tasks(table, before[0], LINKS_PER_TASK)

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = few(few(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = few(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges, now = _kept(few(small.union(few(low)).distinct()))
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, and a fingerprint of them."""
    seen = Observation()
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    kept = materialize(edges, "links", None, seen, F.count("*").alias("n"), digest.alias("digest"))
    return kept, (seen.get["n"], seen.get["digest"])
