"""Previous-row lookup per key that survives a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.operators.joins import null_safe_on


def transitions(
    df: DataFrame, key: str, order: list[str], value: str, bucket: Column, prev: str = "prev", carry: bool = True
) -> DataFrame:
    """Add ``prev``: ``value`` of the preceding row of the same ``key`` in ``order``.

    With ``carry=False`` rows are paired only inside their bucket (an
    event-time slice per key: T8), and the first row of a bucket has no
    previous row.

    ``lag`` over ``partitionBy(key)`` sends every row of a key to one task; a
    key with a third of the data would stall the stage.  Rows are instead
    windowed per ``(key, bucket)`` (``bucket`` is monotone in ``order``, for
    example the hour of the event), and the first row of each bucket takes
    the last value of the key's previous non-empty bucket from a one-row-per-
    bucket summary.  The result equals ``lag(value)`` over the whole key.
    """
    b = df.withColumn("_b", bucket)
    inner = Window.partitionBy(key, "_b").orderBy(*order)
    # A struct keeps "no previous row" (null struct) apart from a null value.
    b = b.withColumn("_p", F.lag(F.struct(F.col(value).alias("v")), 1).over(inner))
    if not carry:
        return b.withColumn(prev, F.col("_p")["v"]).drop("_p", "_b")

    last = b.groupBy(key, "_b").agg(
        F.max(F.struct(*[F.col(c) for c in order], F.struct(F.col(value).alias("v")).alias("_s")))["_s"].alias("_last")
    )
    across = Window.partitionBy(key).orderBy("_b")
    carry = last.select(key, "_b", F.lag("_last", 1).over(across).alias("_carry"))

    firsts = null_safe_on(b.filter(F.col("_p").isNull()), carry, [key, "_b"], "left")
    firsts = firsts.withColumn("_p", F.col("_carry")).drop("_carry")
    rest = b.filter(F.col("_p").isNotNull())
    out = rest.unionByName(firsts)
    return out.withColumn(prev, F.col("_p")["v"]).drop("_p", "_b")
