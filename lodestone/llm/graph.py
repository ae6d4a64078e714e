"""Connected components by hooking labels and jumping over them.

Each round is two grouped aggregations over the edges; hub vertices are safe, because a step only sends each vertex's
minimum through a partial aggregation and joins it back (a join that can be split when skewed). A label carries the value
that a component is to be named by, so nothing is ever grouped by component. Lineage is cut by checkpoint() every
round, so a lost executor costs no more than that round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir

MANY = 10_000  # most rows that are sent to every task


def components(edges: DataFrame, values: DataFrame, rounds: int = 60) -> DataFrame:
    """node, value: the smallest value (nulls last) of all nodes reachable, for each node of the edges (columns a, b). values: node, value, one row a node."""
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct().checkpoint()
    # a label is a value and the node that has it, so that labels tell nodes apart where values do not
    own = values.select("node", F.struct(F.col("value").isNull().alias("none"), "value", F.col("node").alias("at")).alias("label"))
    often = max(64, both.count() // MANY)
    label = own.join(both.select(F.col("a").alias("node")).distinct(), "node", "left_semi").checkpoint()
    for _ in range(rounds):
        # the smallest label among a vertex's neighbours and its own
        near = both.join(label.select(F.col("node").alias("b"), F.col("label").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        hooked = label.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "c").alias("new"))
        # hook the old root too, so that whole trees move at once
        roots = hooked.groupBy(F.col("old.at").alias("node")).agg(F.min("new").alias("r"))
        moved = hooked.join(roots, "node", "left").select("node", "old", F.least("new", F.coalesce("r", "new")).alias("c")).withColumn("at", F.col("c.at")).checkpoint()
        # and then that label's own label; labels of very many vertices, at most MANY of them, are sent to these
        jump = moved.groupBy("at").agg(F.count("*").alias("n")).join(moved.select(F.col("node").alias("at"), F.col("c").alias("j")), "at")
        hot = F.broadcast(jump.where(F.col("n") > often).select("at", "j"))
        rest = moved.join(hot, "at", "left_anti").join(jump.where(F.col("n") <= often).select("at", "j"), "at", "left")
        after = moved.join(hot, "at").unionByName(rest).select("node", "old", F.least("c", F.coalesce("j", "c")).alias("label")).checkpoint()
        changed = after.where("label <> old").limit(1).count()
        label = after.select("node", "label")
        if not changed:
            return label.select("node", F.col("label.value").alias("value"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
