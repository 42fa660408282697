"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.scratch import stored


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Return (node, root): the smallest node reachable over ``edges`` (a, b).

    Alternates two contractions until no edge changes.  Large star: every
    node hangs its larger neighbours below its smallest neighbour.  Small star:
    every node hangs its smaller neighbours, and itself, below the smallest of
    them.  The edge count never grows, minima are partial aggregates, and the
    join with a hub's minimum is an ordinary join that can be split when skewed.
    Every round is written to the shared folder.  Nodes without an edge to
    another node are not returned; null ends are ignored.
    """
    current = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        current = stored(small, "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
