"""Cumulative GMV with Top-N ids and products."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.operators.cumulate import DAY, assign_panes, cumulative_measure, cumulative_top_n
from emporia.operators.cumulate import cumulative_top as cumulative_top_rows

# Fixed values that must equal the reference's: the change ops of live rows.
LIVE_OPS = ("r", "+I", "+U")


def prepare_sales(
    df: DataFrame,
    time_col: str = "event_time",
    day: str | dt.date | None = None,
    ops: tuple[str, ...] | None = None,
) -> DataFrame:
    """Optional op filter and one-day range predicate.

    The day filter is a range on the time column, so it reaches the parquet
    scan as a pushed filter and prunes row groups.
    """
    if ops:
        df = df.filter(F.col("op").isin(*ops))
    if day is not None:
        d = dt.date.fromisoformat(str(day))
        # Wall-clock literals (TIMESTAMP_NTZ parsed from text) do not move
        # with the session time zone the way Python datetime literals do.
        lo = F.to_timestamp_ntz(F.lit(f"{d.isoformat()} 00:00:00"))
        hi = F.to_timestamp_ntz(F.lit(f"{(d + dt.timedelta(days=1)).isoformat()} 00:00:00"))
        df = df.filter((F.col(time_col) >= lo) & (F.col(time_col) < hi))
    return df


# grouping_id() of each grouping set in pane_sets (bit set = column rolled up,
# over the columns window_start, pane, id, product).
GMV_SET, ID_SET, PRODUCT_SET = 3, 1, 2


def pane_sets(
    sales: DataFrame,
    time_col: str = "event_time",
    amount_col: str = "total_amount",
    id_col: str = "id",
    product_col: str = "product_id",
    step_s: int = 600,
    size_s: int = DAY,
    day: str | dt.date | None = None,
    ops: tuple[str, ...] | None = None,
) -> DataFrame:
    """A6/A7 pre-aggregates for all three report branches in one pass.

    Grouping sets (day, pane), (day, pane, id) and (day, pane, product):
    one scan, map-side partial sums for each set, one shuffle.  ``_gid``
    tells the sets apart (a null id is data, not a rolled-up column).
    """
    amount = F.col(amount_col).cast("decimal(18,2)")
    base = prepare_sales(sales, time_col, day, ops).select(time_col, amount.alias("amt"), id_col, product_col)
    base = assign_panes(base, time_col, step_s, size_s)
    cols = ["window_start", "pane", id_col, product_col]
    sets = [["window_start", "pane"], ["window_start", "pane", id_col], ["window_start", "pane", product_col]]
    return base.groupingSets(sets, *cols).agg(F.sum("amt").alias("amt"), F.grouping_id().alias("_gid"))


def _sets_from_totals(panes: DataFrame, id_col: str, product_col: str) -> DataFrame:
    """Grouping-set rows from one-row-per-(window_start, pane, id, product)
    totals (the streaming pane store)."""
    cols = ["window_start", "pane", id_col, product_col]
    sets = [["window_start", "pane"], ["window_start", "pane", id_col], ["window_start", "pane", product_col]]
    return panes.groupingSets(sets, *cols).agg(F.sum("amt").alias("amt"), F.grouping_id().alias("_gid"))


def _ranked_list(gid: int, n: int) -> F.Column:
    """Keys of one grouping set in rank order, comma-joined ('' if none)."""
    item = F.when((F.col("_gid") == gid) & F.col("_key").isNotNull(), F.struct("_rn", "_key"))
    ordered = F.array_sort(F.collect_list(item))
    return F.array_join(F.transform(ordered, lambda x: x["_key"]), ",")


def report_from_panes(
    panes: DataFrame,
    id_col: str = "id",
    product_col: str = "product_id",
    n: int = 5,
    step_s: int = 600,
    size_s: int = DAY,
) -> DataFrame:
    """T5 from pane totals: GMV and Top-N lists per cumulative window.

    ``panes`` is the grouping-set output of ``pane_sets`` or one row per
    (window_start, pane, id, product).  All three sets run through a single
    pipeline keyed by (set, key): one cumulative window per (day, set, key),
    pruned before it is expanded to windows, one Top-N per (window, set), and one aggregate per window that turns the
    sets into the GMV and the two lists.  No branch re-reads the input and
    no join is needed.
    """
    if "_gid" not in panes.columns:
        panes = _sets_from_totals(panes, id_col, product_col)
    gid = F.col("_gid")
    key = F.when(gid == ID_SET, F.col(id_col).cast("string")).when(gid == PRODUCT_SET, F.col(product_col).cast("string"))
    rows = panes.select("window_start", "pane", "_gid", key.alias("_key"), "amt")
    ranked = cumulative_top_rows(rows.withColumnRenamed("amt", "_cum"), ["_gid"], "_key", "_cum", n, step_s, size_s)
    out = ranked.groupBy("window_start", "window_end").agg(
        F.max(F.when(gid == GMV_SET, F.col("_cum"))).alias("gmv"),
        _ranked_list(ID_SET, n).alias(f"top{n}_ids"),
        _ranked_list(PRODUCT_SET, n).alias(f"top{n}_product_ids"),
    )
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("order_date"),
        "window_start",
        "window_end",
        F.col("gmv").cast("decimal(38,2)").alias("gmv"),
        F.coalesce(F.col(f"top{n}_ids"), F.lit("")).alias(f"top{n}_ids"),
        F.coalesce(F.col(f"top{n}_product_ids"), F.lit("")).alias(f"top{n}_product_ids"),
    )


def gmv_topn_report(
    sales: DataFrame,
    time_col: str = "event_time",
    amount_col: str = "total_amount",
    id_col: str = "id",
    product_col: str = "product_id",
    n: int = 5,
    step_s: int = 600,
    size_s: int = DAY,
    day: str | dt.date | None = None,
    ops: tuple[str, ...] | None = None,
) -> DataFrame:
    """T5: one row per (window_start, window_end) with GMV and Top-N lists.

    ``time_col`` is wall-clock TIMESTAMP_NTZ.  Amounts are cast to
    DECIMAL(18,2) before summing (exact, order-independent); GMV leaves as
    DECIMAL(38,2).  Missing lists become ``''``.  Columns: order_date,
    window_start, window_end, gmv, top{n}_ids, top{n}_product_ids.
    """
    panes = pane_sets(sales, time_col, amount_col, id_col, product_col, step_s, size_s, day, ops)
    return report_from_panes(panes, id_col, product_col, n, step_s, size_s)


def cumulative_gmv(sales: DataFrame, time_col: str = "event_time", amount_col: str = "total_amount", **kw) -> DataFrame:
    """Cumulative GMV per (window_start, window_end)."""
    step_s, size_s = kw.get("step_s", 600), kw.get("size_s", DAY)
    base = assign_panes(prepare_sales(sales, time_col, kw.get("day"), kw.get("ops")), time_col, step_s, size_s)
    out = cumulative_measure(base, F.col(amount_col).cast("decimal(18,2)"), "gmv", None, step_s, size_s)
    return out.select("window_start", "window_end", F.col("gmv").cast("decimal(38,2)").alias("gmv"))


def cumulative_top(
    sales: DataFrame, key: str, time_col: str = "event_time", amount_col: str = "total_amount", n: int = 5, **kw
) -> DataFrame:
    """Top-N ``key`` values per cumulative window, comma-joined."""
    step_s, size_s = kw.get("step_s", 600), kw.get("size_s", DAY)
    base = assign_panes(prepare_sales(sales, time_col, kw.get("day"), kw.get("ops")), time_col, step_s, size_s)
    return cumulative_top_n(base, key, F.col(amount_col).cast("decimal(18,2)"), n, kw.get("name"), step_s, size_s)


def daily_sales(sales: DataFrame, day: str | dt.date, time_col: str = "event_time") -> DataFrame:
    """The 8-column view of live rows (E10) on one day."""
    live = prepare_sales(sales, time_col, day, LIVE_OPS)
    return live.select("id", "order_id", "user_name", "product_id", "sale_num", "total_amount", time_col, "op")
