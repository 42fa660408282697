"""Top-N per group, latest row per key, ordered list aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str = "_rn") -> DataFrame:
    """Rows with ``row_number() <= n`` per ``keys`` under ``order``.

    Spark inserts a partial WindowGroupLimit before the exchange, so only
    ``n`` rows per group and task are shuffled, even for a hot group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def listagg(value: str, order: str, sep: str = ",") -> Column:
    """A8/A9 as an aggregate expression: ``listagg(value, sep) WITHIN GROUP
    (ORDER BY order)``.  Meant for bounded groups (after ``top_n`` or a
    per-day explode); nulls are skipped and an all-null group gives null,
    like LISTAGG."""
    item = F.struct(F.col(order).alias("o"), F.col(value).cast("string").alias("v"))
    pairs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), item)))
    joined = F.array_join(F.transform(pairs, lambda s: s["v"]), sep)
    return F.when(F.size(pairs) > 0, joined)


def joined_list(df: DataFrame, keys: list[str], value: str, order: str, name: str, sep: str = ",") -> DataFrame:
    """``listagg`` per ``keys`` as a DataFrame."""
    return df.groupBy(*keys).agg(listagg(value, order, sep).alias(name))


def latest_by(df: DataFrame, keys: list[str], order: list[str], cols: list[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` per ``keys``.

    Written as ``max_by`` over a struct, a plain aggregate: partial
    aggregation keeps one candidate per key and task before the shuffle, so a
    key holding a third of all rows costs no more than any other key.
    Ties on ``order`` are broken by the remaining columns (deterministic).
    """
    cols = cols or [c for c in df.columns if c not in keys]
    rest = [c for c in cols if c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col("_best")[c].alias(c) for c in cols])
