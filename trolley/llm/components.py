"""Connected components by contracting edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import Scratch, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node on an edge (a, b); nodes of one component share their root.

    Each round points every node to the least of itself and its neighbours and replaces edges by
    those between the nodes pointed to, which leaves far fewer. All steps are aggregates and joins;
    nothing but a count of edges comes to the driver.
    """
    both = edges.where("a <> b").select("a", "b").unionAll(edges.where("a <> b").select("b", "a")).distinct()
    with Scratch(edges.sparkSession) as scratch:
        left = scratch.stored(both, "edges")
        roots = left.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
        while left.count():
            up = left.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("up"))
            up = scratch.stored(up, "pointers")
            for _ in range(2):
                higher = up.select(F.col("a").alias("up"), F.col("up").alias("higher"))
                up = up.join(higher, "up").select("a", F.col("higher").alias("up"))
            up = scratch.stored(up, "pointers")
            roots = roots.join(up.select(F.col("a").alias("root"), "up"), "root", "left")
            roots = scratch.stored(roots.select("node", F.coalesce("up", "root").alias("root")), "roots")
            ends = up.select(F.col("a").alias("b"), F.col("up").alias("to"))
            left = left.join(up, "a").join(ends, "b").where("up <> to").select(F.col("up").alias("a"), F.col("to").alias("b"))
            left = scratch.stored(left.distinct(), "edges")
        return stored(roots, "components")
