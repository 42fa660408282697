"""Cumulative windows (T1): step ``s`` inside a window of size ``S``.

An event at time ``t`` in the size window starting at ``W`` belongs to every
window ``[W, W + k*s)`` with ``W + k*s > t``.  Expanding each event into its
windows multiplies the input by up to ``S/s`` (144 for 10 min / 1 day).
Instead we

1. tag each row with its *pane* (the first window end that contains it),
2. aggregate per pane (map-side partial aggregation, one shuffle),
3. run a cumulative sum over the panes of one size window and key — at most
   ``S/s`` rows per group, whatever the skew of the input, and
4. expand each pane row only to the window ends up to the key's next active
   pane, so every (window, key) appears once, as in the windowed result.

Window ends repeat after a quiet pane because the window still holds the
earlier rows; a window is produced only once it holds at least one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.time import seconds_of_day

DAY = 86400


def _check(step_s: int, size_s: int) -> None:
    if step_s <= 0 or size_s % step_s or DAY % size_s:
        raise ValueError("step must divide size, and size must divide one day")


def assign_panes(df: DataFrame, time_col: str, step_s: int = 600, size_s: int = DAY) -> DataFrame:
    """Add ``window_start`` (TIMESTAMP_NTZ) and ``pane`` (1-based end index).

    ``time_col`` is a wall-clock TIMESTAMP_NTZ; windows align to local
    midnight.  Convert instants with ``functions.local_time`` first.
    """
    _check(step_s, size_s)
    sod = seconds_of_day(time_col)
    day = F.to_date(time_col).cast("timestamp_ntz")
    offset = F.floor(sod / size_s) * size_s
    return df.withColumns(
        {
            "window_start": day + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset),
            "pane": (F.floor((sod - offset) / step_s) + 1).cast("int"),
        }
    )


def _window_end(step_s: int) -> Column:
    return F.col("window_start") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.col("pane") * F.lit(step_s)
    )


def _running(panes: DataFrame, keys: list[str], value: str, step_s: int, size_s: int) -> DataFrame:
    """Running sum over the panes of (window_start, *keys); each row holds for the ends
    from ``pane`` to ``_next`` - 1."""
    last = size_s // step_s
    w = Window.partitionBy("window_start", *keys).orderBy("pane")
    return panes.withColumns(
        {
            value: F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_next": F.lead("pane", 1, last + 1).over(w),
        }
    )


def _expand(run: DataFrame, step_s: int) -> DataFrame:
    """One row per window end that a running sum holds for."""
    return (
        run.withColumn("pane", F.explode(F.sequence(F.col("pane"), F.col("_next") - 1)))
        .drop("_next")
        .withColumn("window_end", _window_end(step_s))
    )


def prune_below_top(run: DataFrame, group: list[str], key: str, value: str, n: int, block: int = 12) -> DataFrame:
    """Running sums without those that can be in no window's Top-``n``.

    Window ends are taken in blocks.  A key whose largest sum in a block is below the
    ``n``-th largest of the smallest sums, over the keys that are present all
    through the block, is below ``n`` keys in each of its windows.  Ties stay, and
    sums may fall (refunds).  Only what is left need be expanded to window ends; a
    key has at most one row a block more than before.
    """
    blocks = F.sequence(F.floor((F.col("pane") - 1) / block), F.floor((F.col("_next") - 2) / block))
    cut = run.withColumn("_blk", F.explode(blocks))
    low = F.greatest(F.col("pane"), F.col("_blk") * block + 1).cast("int")
    high = F.least(F.col("_next") - 1, F.col("_blk") * block + block).cast("int")
    cut = cut.withColumns({"pane": low, "_next": high + 1})
    w = Window.partitionBy("window_start", *group, key, "_blk")
    cut = cut.withColumns({"_max": F.max(value).over(w), "_min": F.min(value).over(w), "_from": F.min("pane").over(w)})
    slot = ["window_start", *group, "_blk"]
    present = (F.col("_from") == F.col("_blk") * block + 1) & (F.col("pane") == F.col("_from"))
    best = Window.partitionBy(*slot).orderBy(F.desc("_min"))
    # The n-th row of a slot; a slot with fewer keys has none and keeps everything.
    bar = cut.filter(present).select(*slot, "_min", F.row_number().over(best).alias("_rn")).filter(F.col("_rn") <= n)
    bar = bar.groupBy(*slot).agg(F.min("_min").alias("_bar"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == n)
    kept = cut.join(bar.drop("_n"), slot, "left").filter(F.col("_bar").isNull() | (F.col("_max") >= F.col("_bar")))
    return kept.select(*run.columns)


def cumulative_measure(
    df: DataFrame,
    measure: Column,
    name: str,
    keys: list[str] | None = None,
    step_s: int = 600,
    size_s: int = DAY,
    preaggregated: bool = False,
) -> DataFrame:
    """Cumulative ``sum(measure)`` per (window_start, window_end, *keys).

    ``df`` must carry ``window_start`` and ``pane`` (see ``assign_panes``).
    ``preaggregated`` says ``df`` already holds one row per (window_start,
    pane, *keys), so no aggregation (and no shuffle) precedes the window.
    """
    keys = keys or []
    if preaggregated:
        panes = df.select("window_start", "pane", *keys, measure.alias(name))
    else:
        panes = df.groupBy("window_start", "pane", *keys).agg(F.sum(measure).alias(name))
    return _expand(_running(panes, keys, name, step_s, size_s), step_s)


def cumulative_top(
    panes: DataFrame, group: list[str], key: str, value: str, n: int, step_s: int = 600, size_s: int = DAY, rank: str = "_rn"
) -> DataFrame:
    """Rows of the Top-``n`` keys by cumulative ``value`` per (window_start, window_end,
    *group), with ``rank``; from one row per (window_start, pane, *group, key).  Ties
    break on the key."""
    from emporia.operators.ranking import top_n

    run = prune_below_top(_running(panes, [*group, key], value, step_s, size_s), group, key, value, n)
    return top_n(_expand(run, step_s), ["window_start", "window_end", *group], [F.desc(value), F.asc(key)], n, rank)


def cumulative_top_n(
    df: DataFrame,
    key: str,
    measure: Column,
    n: int = 5,
    name: str | None = None,
    step_s: int = 600,
    size_s: int = DAY,
    preaggregated: bool = False,
) -> DataFrame:
    """Top-``n`` values of ``key`` by cumulative ``sum(measure)`` per window.

    Ranked by sum desc, then key asc (the tie-break the source left open).
    Returns (window_start, window_end, <name>) with the keys comma-joined in
    rank order.  The row_number filter plans as a partial WindowGroupLimit
    ahead of the shuffle, so each task forwards at most ``n`` rows per
    window.
    """
    from emporia.operators.ranking import joined_list

    name = name or f"top{n}_{key}s"
    if preaggregated:
        panes = df.select("window_start", "pane", key, measure.alias("_cum"))
    else:
        panes = df.groupBy("window_start", "pane", key).agg(F.sum(measure).alias("_cum"))
    ranked = cumulative_top(panes, [], key, "_cum", n, step_s, size_s)
    return joined_list(ranked, ["window_start", "window_end"], key, "_rn", name)
