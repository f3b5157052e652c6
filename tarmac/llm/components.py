"""Connected components by contraction, all in joins and aggregations."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import checkpointed, removed, written


def _ranked(node: str, turn: int) -> Column:
    return F.struct(F.xxhash64(F.lit(turn), node).alias("rank"), F.col(node).alias("node"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of undirected edges (a, b); component = a node of it.

    Each round hangs every node on the first node of its neighbourhood (two steps far) in an
    order that is drawn anew by hashing, so paths shrink by a factor whatever their ids; it renames the edges accordingly and drops loops and repeats, until no edge is left.  Every
    round's tables are written to the shared folder, so a lost executor never repeats earlier
    rounds, and are removed once the next round has its own.  Minima are aggregated map-side;
    the joins leave hot nodes to AQE's skew handling.
    """
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges, edges_at = written(pairs.distinct())
    names, names_at = None, None
    for turn in itertools.count():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.groupBy("a").agg(F.min(_ranked("b", turn)).alias("_m")).select(
            "a", F.least(_ranked("a", turn), "_m")["node"].alias("p")
        )
        far = near.select(F.col("a").alias("p"), F.col("p").alias("q"))
        parent, parent_at = written(
            near.join(far, "p", "left").select(F.col("a").alias("node"), F.coalesce("q", "p").alias("component"))
        )
        spent = [edges_at]
        if names is None:
            names, names_at = parent, parent_at
        else:
            step = parent.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            spent += [names_at, parent_at]
            names, names_at = written(
                names.join(step, "component", "left").select("node", F.coalesce("_next", "component").alias("component"))
            )
        left = parent.select(F.col("node").alias("a"), F.col("component").alias("_a"))
        right = parent.select(F.col("node").alias("b"), F.col("component").alias("_b"))
        edges, edges_at = written(
            edges.join(left, "a").join(right, "b").where("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct()
        )
        removed(spark, spent)
        if edges.isEmpty():
            found = checkpointed(names)
            removed(spark, [edges_at, names_at])
            return found
