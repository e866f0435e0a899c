"""Connected components of a graph given as edges, by shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import ensure_checkpoint_dir


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the component's smallest node.

    Each round hooks every node to its smallest neighbour if that is smaller,
    follows the hooks to their ends by doubling, and keeps only the edges between
    different ends, so what a round joins shrinks quickly.  Rounds are
    checkpointed in the shared folder.  Self-loops give a node of its own; null
    ends and an empty table give none."""
    ensure_checkpoint_dir(edges.sparkSession)
    given = edges.select("a", "b").na.drop()
    both = given.unionByName(given.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    found = both.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root")).checkpoint()
    live = both.where("a <> b")
    while not live.isEmpty():
        hooks = live.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("end")).checkpoint()
        while True:
            ends = hooks.select(F.col("node").alias("end"), F.col("end").alias("further"))
            moved = hooks.join(ends, "end").select("node", F.col("further").alias("end"), (F.col("further") != F.col("end")).alias("moved")).checkpoint()
            hooks = moved.select("node", "end")
            if moved.where("moved").isEmpty():
                break
        found = (found.join(hooks.select(F.col("node").alias("root"), "end"), "root", "left")
                 .select("node", F.coalesce("end", "root").alias("root")).checkpoint())
        live = (live.join(hooks.toDF("a", "x"), "a").join(hooks.toDF("b", "y"), "b").where("x <> y")
                .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct().checkpoint())
    return found
