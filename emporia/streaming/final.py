"""Stream jobs that write each window once, when it is closed.

``start_gmv_final`` closes cumulative windows by an event-time watermark it keeps in a
table of its own, since a row that is late for one window still counts in the later
windows of its day, which no append-mode aggregate can do.  ``start_arrival_paths``
uses windows on the time of arrival, which Spark's own watermark closes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emporia.functions.text import PATH_ARROW
from emporia.functions.time import DEFAULT_TZ, wall_clock
from emporia.operators.cumulate import DAY, assign_panes
from emporia.plans import gmv, logs
from emporia.streaming import store
from emporia.streaming.jobs import _session_tz, _start

PROGRESS = "watermark string, dropped long"


def _literal(t: dt.datetime):
    return F.to_timestamp_ntz(F.lit(t.isoformat(sep=" ")))


def start_gmv_final(
    sales: DataFrame, out: str, checkpoint: str, lateness_s: int = 5, id_col: str = "id", product_col: str = "product_id", n: int = 5,
    step_s: int = 600, time_col: str = "event_time", amount_col: str = "total_amount", trigger: dict | None = None, tz: str | None = None,
    day: str | None = None, ops: tuple[str, ...] | None = None,
) -> StreamingQuery:
    """T2-T5 with final windows only: a cumulative window is written to ``out/report`` once
    the watermark (the greatest event time so far less ``lateness_s``) has passed its end, and
    never again.

    A row counts in the windows of its day that were still open when its batch began:
    its pane is the first such window's.  A row whose day is closed is dropped and
    counted (``dropped_late``).  Every batch stores its pane sums under its own number,
    reads the sums of the days whose windows it closes, and notes the new watermark.
    All three replace what an earlier attempt of the batch wrote and follow from the
    input and the batches before, so a replay writes the same windows again.  Pane sums
    of closed days are deleted.
    """
    if isinstance(sales.schema[time_col].dataType, T.TimestampType):
        sales = sales.withColumn(time_col, wall_clock(time_col, tz or _session_tz(sales)))
    sales = gmv.prepare_sales(sales, time_col, day, ops)
    rows = sales.select(F.col(time_col).alias("_t"), F.col(amount_col).cast("decimal(18,2)").alias("amt"), id_col, product_col)
    keys = ["window_start", "pane", id_col, product_col]

    def flush(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = store.read_progress(spark, f"{out}/progress", epoch) or {"watermark": None, "dropped": 0}
        mark = dt.datetime.fromisoformat(before["watermark"]) if before["watermark"] else None
        panes = assign_panes(batch, "_t", step_s)
        if mark:
            past = F.timestamp_diff("MICROSECOND", "window_start", _literal(mark))
            panes = panes.withColumn("pane", F.greatest("pane", (F.floor(past / (step_s * 1_000_000)) + 1).cast("int")))
        seen = panes.agg(F.max("_t").alias("last"), F.count(F.when(F.col("pane") > DAY // step_s, 1)).alias("late")).first()
        if seen["last"] is None:
            return
        sums = panes.filter(F.col("pane") <= DAY // step_s).groupBy(*keys).agg(F.sum("amt").alias("amt"))
        store.append_epoch(sums.withColumn("day", F.to_date("window_start")), f"{out}/panes", epoch, ("day",))
        reached = max(x for x in (mark, seen["last"] - dt.timedelta(seconds=lateness_s)) if x is not None)
        _write_closed(spark, mark, reached, epoch)
        store.write_progress(spark, f"{out}/progress", epoch, {"watermark": reached.isoformat(sep=" "), "dropped": before["dropped"] + seen["late"]}, PROGRESS)
        if mark:
            store.drop_partitions(spark, f"{out}/panes", "day", mark.date().isoformat())

    def _write_closed(spark: SparkSession, mark: dt.datetime | None, reached: dt.datetime, epoch: int) -> None:
        """Windows that end behind ``mark`` and not behind ``reached``."""
        panes = spark.read.parquet(f"{out}/panes").filter((F.col(store.EPOCH) <= epoch) & (F.col("day") <= F.lit(reached.date())))
        if mark:
            panes = panes.filter(F.col("day") >= F.lit(mark.date()))
        end = F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("pane") * step_s)
        report = gmv.report_from_panes(panes.filter(end <= _literal(reached)).select(*keys, "amt"), id_col, product_col, n, step_s, DAY)
        report = report.filter(F.col("window_end") <= _literal(reached))
        if mark:
            report = report.filter(F.col("window_end") > _literal(mark))
        store.append_epoch(report, f"{out}/report", epoch)

    return _start(rows, flush, checkpoint, "append", trigger, None)


def read_gmv_final(spark: SparkSession, out: str) -> DataFrame:
    """All closed windows; each stands in the rows of one batch."""
    return spark.read.parquet(f"{out}/report").drop(store.EPOCH)


def dropped_late(spark: SparkSession, out: str) -> int:
    """Rows that came when all windows of their day were closed."""
    last = store.read_progress(spark, f"{out}/progress", 1 << 62)
    return last["dropped"] if last else 0


def start_arrival_paths(
    log_stream: DataFrame, out: str, checkpoint: str, arrived: str = "arrived", user_window: str = "10 seconds", flush_window: str = "15 seconds",
    delay: str = "0 seconds", tz: str = DEFAULT_TZ, seq: str | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """M4 by arrival, as the source runs it: T8 and T9.

    Rows of a user that arrive in the same ``user_window`` are put in (ts, seq) order, and
    neighbours of different page types are a path.  Paths are counted by day in every
    ``flush_window`` in which a user window ends.  Both are tumbling windows on the
    arrival stamp (a Kafka record's timestamp, an ingest time), closed by a watermark on
    it, so what is written is final, and a batch that runs again writes the same.  Rows
    without a user have no path.  A user window holds what one user sends in seconds.
    """
    rows = log_stream.withWatermark(arrived, delay).filter(F.col("user_id").isNotNull())
    rows = logs.normalise(rows, tz).select(arrived, "user_id", F.struct("ts", (F.col(seq) if seq else F.lit(0)).cast("long").alias("seq"), "log_type", "log_date").alias("row"))
    grouped = rows.groupBy(F.window(arrived, user_window).alias("_w"), "user_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    # Neighbours: all rows but the last beside all but the first.
    pairs = F.arrays_zip(F.slice("rows", 1, F.size("rows") - 1).alias("a"), F.slice("rows", 2, F.size("rows")).alias("b"))
    moves = grouped.select(F.window_time("_w").alias("_t"), F.explode(pairs).alias("p")).select("_t", "p.a.log_type", F.col("p.b.log_type").alias("next"), "p.b.log_date")
    moves = moves.filter(F.col("log_type") != F.col("next")).select("_t", "log_date", F.concat("log_type", F.lit(PATH_ARROW), "next").alias("path"))
    counts = moves.groupBy(F.window("_t", flush_window).alias("_w"), "log_date", "path").agg(F.count(F.lit(1)).alias("cnt"))
    flushed = counts.select(wall_clock(F.col("_w.end"), _session_tz(log_stream)).alias("flush_end"), "log_date", "path", "cnt")
    return _start(flushed, lambda b, e: store.append_epoch(b, out, e), checkpoint, "append", trigger, None)


def path_line(date="log_date", path="path", count="total"):
    """a flushed line, ``date (path,count)``."""
    return F.format_string("%s (%s,%d)", F.col(date).cast("string"), F.col(path), F.col(count))


def read_arrival_paths(spark: SparkSession, out: str) -> DataFrame:
    """What each flush prints, sorted by flush, day and path: the paths counted in it,
    the day's total of the path by then, and the line.  A (day, path) has at most a row
    a flush, however many users."""
    so_far = Window.partitionBy("log_date", "path").orderBy("flush_end")
    rows = spark.read.parquet(out).drop(store.EPOCH).withColumn("total", F.sum("cnt").over(so_far))
    return rows.withColumn("line", path_line()).orderBy("flush_end", "log_date", "path")
