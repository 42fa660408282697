"""Running sums and ranks of keys of any size.

``sum(...) over (partition by key order by ...)`` sends all rows of a key to one task.
Here rows are dealt by ranges of (key, order), so a large key lies in many parts.  Each
part sums on its own; what the earlier parts of a key hold comes from a table of one row
per key and part.  The dealt rows are written to the shared folder first: parts must be
the same for both uses, also when a lost executor's work is done again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.joins import null_safe_on
from emporia.session import scratch_path

PART = "_part"


def dealt_by_range(df: DataFrame, keys: list[str], order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` with ``_part``, written and read back: consecutive ranges of (keys, order)."""
    spark = df.sparkSession
    columns = [F.col(k) for k in keys] + order
    ranged = df.repartitionByRange(parts, *columns) if parts else df.repartitionByRange(*columns)
    path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
    ranged.withColumn(PART, F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.IntegerType())])).parquet(path)


def running_sum(
    df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str, before: bool = False, parts: int | None = None
) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same ``keys`` up to each
    row in ``order`` (with ``before``, up to the row before; 0 for the first).

    ``order`` must tell the rows of a key apart.  Null keys form a key.  A row is
    shuffled twice, whatever its key's size.
    """
    rows = dealt_by_range(df.withColumn("_value", value), keys, order, parts)
    per = rows.groupBy(PART, *keys).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(PART, *keys, F.sum("_sum").over(earlier).alias("_offset"))
    inside = Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    local = rows.withColumn("_local", F.sum("_value").over(inside))
    both = null_safe_on(local, offsets, [PART, *keys], "left")
    zero = F.lit(0).cast(both.schema["_local"].dataType)
    total = F.coalesce("_local", zero) + F.coalesce("_offset", zero)
    return both.withColumn(name, total).select(*df.columns, name)


def ranked(df: DataFrame, keys: list[str], value: str, name: str = "rk", parts: int | None = None) -> DataFrame:
    """``df`` with ``name``: ``rank() over (partition by keys order by value desc)``.

    A rank is one more than the rows of the key with a greater value: a running sum of
    the counts per value, so neither a large key nor a large tie meets in one task.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    greater = running_sum(counts, keys, [F.desc(value)], F.col("_n"), "_greater", before=True, parts=parts)
    greater = greater.select(*keys, value, (F.col("_greater") + 1).cast("int").alias(name))
    return null_safe_on(df, greater, [*keys, value], "left").select(*df.columns, name)
