"""Mixing sources to target weights.

Sizes are summed per source (a partial aggregate, so a hot source costs one row a
task), targets are solved on the table of sources, and every document is taken
floor(rate) times plus once more when its seeded hash falls below the fraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def text_size(column: str = "text"):
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_rate: int) -> DataFrame:
    """(source, source_size, target) from a table of (source, size).

    Sources in code point order, null last, take ``weights`` in turn and share
    the whole size by weight.  A target stops at ``max_rate`` times its source's
    size and the excess goes to the others by weight, until none is above.  In
    order of cap per weight the capped sources come first, so running sums give
    the share per weight that is left after each of them; the right one is the
    largest that its own source can bear.  The windows run over one row a source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ranked = per.select("source", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * max_rate).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    tried = ranked.withColumn("level", (total - before) / left)
    bears = F.col("cap") >= F.col("level") * F.col("weight")
    level = F.max(F.when(bears, F.col("level"))).over(Window.partitionBy())
    return tried.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"))


ADDED = ["size", "source_size", "target", "rate", "copies"]


def _mixed(docs: DataFrame, weights: tuple[int, ...], max_rate: int, seed: str, prefix: str) -> DataFrame:
    """``docs`` with ``ADDED``, each name behind ``prefix``."""
    size, whole, target, rate, copies = (prefix + x for x in ADDED)
    sized = docs.withColumn(size, text_size())
    targets = source_targets(sized.select("source", F.col(size).alias("size")), weights, max_rate)
    targets = targets.select(F.col("source").alias(prefix + "source"), F.col("source_size").alias(whole), F.col("target").alias(target))
    share = F.when(F.col(whole) > 0, F.col(target) / F.col(whole)).otherwise(F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10)
    once_more = draw.cast("double") / F.lit(float(2**52)) < F.col(rate) - F.floor(rate)
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col(prefix + "source")))
        .drop(prefix + "source")
        .withColumn(rate, share)
        .withColumn(copies, F.floor(rate) + once_more.cast("long"))
    )


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_rate: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with size, source_size, target, rate and copies.

    ``copies`` is how often the mix takes the row.  The draw is a hash of the
    seed and doc_id alone: reruns agree, and repeated rows of one doc_id agree with
    each other.  A null or empty text has size 0; a source without any word has
    target and copies 0; a null source is a source; a null doc_id draws as the
    empty string.  Columns of ``docs`` with one of the five names are replaced.
    """
    mixed = _mixed(docs.drop(*ADDED), weights, max_rate, seed, "_mix_")
    return mixed.withColumnsRenamed({"_mix_" + x: x for x in ADDED})


def emit_mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_rate: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Every row of ``docs`` as often as the mix takes it, with its own columns."""
    mixed = _mixed(docs, weights, max_rate, seed, "_mix_").where("_mix_copies > 0")
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))).alias("_mix_copy")
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], copy).drop("_mix_copy")
