"""Connected components by alternating large-star and small-star steps, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import written


def _kept(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The written edges, and their number and hash sum."""
    out = written(edges, name)
    return out, tuple(out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())


def component_hints(edges: DataFrame) -> DataFrame:
    """(node, root) after one large-star step: nodes with one root are in one component, though a
    component may still have several roots."""
    ab = ["a", "b"]
    both = edges.filter("a <> b").select(*ab).unionByName(edges.filter("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    far = both.join(low.select(F.col("a").alias("b"), F.col("m").alias("far")), "b").groupBy("a").agg(F.min("far").alias("root"))
    return far.select(F.col("a").alias("node"), "root")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Edges (a, b) of any orderable type -> (node, root), root the smallest node within reach.

    Only nodes with an edge appear. A round sends every node's smallest neighbour to its larger ones,
    then to its smaller ones; minima are partial aggregates and the joins' edge side may be split by
    AQE, so a node with very many edges is no hot task. Each round is written to the shared folder.
    """
    ab = ["a", "b"]
    cur, state = _kept(edges.filter("a <> b").select(F.greatest(*ab).alias("a"), F.least(*ab).alias("b")).distinct(), "cc-0")
    for k in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, f"cc-{k}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur, now = _kept(down.unionByName(low.withColumnRenamed("m", "b")).distinct(), f"cc-{k}-small")
        if now == state or not now[0]:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
