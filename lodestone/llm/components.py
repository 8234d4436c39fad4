"""Connected components by contraction, for graphs that fit no single machine.

Every round each vertex hooks to the neighbour (or itself) that a round-dependent hash ranks lowest, edges are rewritten
to the roots and deduplicated. A constant share of the vertices disappears per round in expectation, whatever the shape
of the graph, so long chains take as few rounds as stars. Both steps are aggregations with map-side combine and joins on
vertices that adaptive execution splits where a vertex is hot; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.session import materialize

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``edges(a, b)``; equal roots mean connected. Self loops are allowed."""
    kind = edges.schema["a"].dataType.simpleString()
    current = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    loops = edges.select(F.explode(F.array("a", "b")).alias("v")).distinct()
    label = None
    for k in range(MAX_ROUNDS):
        if current.isEmpty():
            break
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(k), c).alias("h"), c.alias("v"))
        best = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        hook = materialize(best.select(F.col("a").alias("v"), F.least("m", rank(F.col("a")))["v"].cast(kind).alias("to")), f"cc-hook-{k}")
        ha, hb = hook.select(F.col("v").alias("a"), F.col("to").alias("ra")), hook.select(F.col("v").alias("b"), F.col("to").alias("rb"))
        moved = current.join(ha, "a").join(hb, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        current = materialize(moved, f"cc-edges-{k}")
        step = hook.where("v <> to")
        if label is None:
            label = hook.select("v", F.col("to").alias("root"))
        else:
            s = step.select(F.col("v").alias("root"), F.col("to").alias("next"))
            label = materialize(label.join(s, "root", "left").select("v", F.coalesce("next", "root").alias("root")), f"cc-label-{k}")
    else:
        raise RuntimeError("contraction did not end")
    if label is None:
        return loops.select("v", F.col("v").alias("root"))
    return loops.join(label, "v", "left").select("v", F.coalesce("root", "v").alias("root"))
