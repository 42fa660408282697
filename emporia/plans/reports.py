"""Report SQL over the GMV report table.

The report table holds one row per (ds, window_end); only the latest window
of each day is reported.  Ids are comma-joined; the missing-data sentinel
is dropped before the dimension join.  Every aggregate here sees at most a
few rows per day, so the plans are dominated by one scan of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.text import MISSING, growth_rate, percent_text
from emporia.operators.generators import explode_split
from emporia.operators.joins import prev_day_join, with_dimension
from emporia.operators.ranking import latest_by, listagg

SNAPSHOT_COLS = ["window_start", "window_end", "win_gmv", "top5_product_ids"]
TOP_N = 5.0


def latest_snapshot(report: DataFrame) -> DataFrame:
    """Each day's row with the latest ``window_end``."""
    return latest_by(report, ["ds"], ["window_end"], SNAPSHOT_COLS)


def exploded_ids(report: DataFrame, drop_missing: bool = True) -> DataFrame:
    """Latest row per day, one row per listed id (``pos`` keeps list order)."""
    rows = explode_split(latest_snapshot(report), "top5_product_ids", ",", "exploded_product_id", "pos")
    if drop_missing:
        rows = rows.filter(F.col("exploded_product_id") != MISSING)
    return rows


def top_products(report: DataFrame, products: DataFrame) -> DataFrame:
    """R2: latest Top-5 ids per day with their descriptions (left join; a
    duplicate product id in the dimension fans out)."""
    rows = exploded_ids(report)
    out = with_dimension(rows, products, rows["exploded_product_id"] == products["product_id"], "left")
    return out.select("ds", "window_end", "win_gmv", "pos", "exploded_product_id", "product_desc")


def day_summary(report: DataFrame, products: DataFrame) -> DataFrame:
    """Per day: latest window, GMV, ids and descriptions joined in list order, and the
    list as an array (``_ids``, the sentinel included).  ``_listed`` counts the ids
    that are not the sentinel."""
    rows = exploded_ids(report, drop_missing=False)
    rows = with_dimension(rows, products, rows["exploded_product_id"] == products["product_id"], "left")
    real = F.col("exploded_product_id") != MISSING
    rows = rows.withColumns({"_desc": F.when(real, F.col("product_desc")), "_id": F.when(real, F.col("exploded_product_id"))})
    keys = ["ds", "window_start", "window_end", "win_gmv"]
    return rows.groupBy(*keys).agg(
        listagg("_desc", "pos").alias("top5_product_descs"),
        listagg("_id", "pos").alias("top5_product_ids"),
        F.collect_set("exploded_product_id").alias("_ids"),
        F.count("_id").alias("_listed"),
    )


def growth(report: DataFrame, products: DataFrame) -> DataFrame:
    """Day-over-day GMV growth with descriptions; null without a
    previous day or with a zero previous GMV."""
    cur = day_summary(report, products).filter("_listed > 0")
    prev = cur.select("ds", F.col("win_gmv").alias("_prev_gmv"))
    out = prev_day_join(cur, prev, "ds")
    return out.select(
        "ds",
        "window_start",
        "window_end",
        "win_gmv",
        "top5_product_descs",
        percent_text(growth_rate("win_gmv", "_prev_gmv")).alias("mon_rate"),
    ).orderBy("ds")


def repeat_rate(
    report: DataFrame, products: DataFrame, with_prev_descs: bool = False, drop_missing_in_overlap: bool = False
) -> DataFrame:
    """R4/J5/J6 (R5 with ``with_prev_descs``): growth plus yesterday's ids and the Top-5
    repeat rate ``shared / 5``; null, not 0 %, when nothing is shared.

    The previous row is attached if it is the day before, and the overlap is the size of an array
    intersection.  The sentinel is *not* dropped there by default (as in the
    source), so two days that both miss data share it; a day that lists nothing but
    the sentinel has no row and, as a previous day, no GMV or lists.
    """
    days = day_summary(report, products)
    known = F.col("_listed") > 0
    last = {"last_day_product_ids": "top5_product_ids", "last_day_product_descs": "top5_product_descs", "_prev_gmv": "win_gmv"}
    past = F.struct("ds", F.col("_ids").alias("_prev_ids"), *[F.when(known, F.col(c)).alias(n) for n, c in last.items()])
    # The day table has a row a day, so its order is a small window; planning it once
    # halves the work under it.
    row = F.lag(past).over(Window.orderBy("ds"))
    out = days.withColumn("_past", row).withColumn("_past", F.when(F.datediff("ds", "_past.ds") == 1, F.col("_past")))
    out = out.filter(known).select(*days.columns, *[F.col(f"_past.{c}").alias(c) for c in ("_prev_ids", *last)])
    shared = F.array_intersect("_ids", "_prev_ids")
    if drop_missing_in_overlap:
        shared = F.array_remove(shared, MISSING)
    n = F.when(F.size(shared) > 0, F.size(shared))
    cols = [
        "ds",
        "window_start",
        "window_end",
        "win_gmv",
        "top5_product_ids",
        "last_day_product_ids",
        "top5_product_descs",
    ]
    if with_prev_descs:
        cols.append("last_day_product_descs")
    return out.select(
        *cols,
        percent_text(growth_rate("win_gmv", "_prev_gmv")).alias("mon_rate"),
        percent_text(n / F.lit(TOP_N) * 100).alias("repeat_rate"),
    ).orderBy("ds")
