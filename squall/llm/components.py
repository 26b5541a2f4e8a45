"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm.work import written


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Each round links the larger neighbours of every node to its smallest neighbour
    (large star), then its smaller neighbours likewise (small star), until the edges
    no longer change. Both steps keep components and only ever lower the far end of
    an edge, so the edges end as stars around each component's smallest node. Every
    step is a minimum per node, pre-aggregated, and a join back on the node; the
    edges of each round are written to the shared folder. Nothing is collected but
    two counts.

    Rows with a null or with two equal ends are no edges. Raises if ``max_rounds``
    do not suffice (rounds grow with the logarithm of the longest path).
    """
    rows = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    rows = written(rows.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        rows = written(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        now = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = rows.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return rows.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
