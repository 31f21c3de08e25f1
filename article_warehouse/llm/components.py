"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from article_warehouse.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of each node of ``edges`` (a, b: long): node, root (its smallest node).

    Rounds of large-star and small-star steps: each node's neighbours are linked to the smallest node
    seen. Each step is a partial aggregate and a join on the node; the minima are stored first, so that
    both sides of the join are shuffled and a hub's edges can be split. It ends when the edges form stars.
    """
    edges = stored(_downward(edges))
    before = None
    while True:
        edges = stored(_step(_step(edges, large=True), large=False))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("high", "low"), F.lit(1 << 40)))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)


def _downward(edges: DataFrame) -> DataFrame:
    high, low = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    return edges.select(high, low).where("high <> low").distinct()


def _step(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    if large:
        both = both.unionByName(edges.select(F.col("low").alias("node"), F.col("high").alias("other")))
    minima = stored(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least")))
    linked = both.join(minima, "node")
    if large:
        pairs = linked.where("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    else:
        own = minima.select(F.col("node").alias("a"), F.col("least").alias("b"))
        pairs = linked.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(own)
    return _downward(pairs)
