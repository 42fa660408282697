"""Streaming jobs: log metrics, cumulative GMV report, change current state.

No job drops late rows unless it is told to: ``lateness`` or ``watermark`` bounds
the state and is None by default.  ``fail_on_drops`` raises when a query that was
given one has dropped rows.

Every ``start_*`` function returns a started ``StreamingQuery`` that writes
into ``out`` (a folder) with its checkpoint under ``checkpoint``.  Pass
``trigger={"availableNow": True}`` to drain the input and stop, or
``{"processingTime": "15 seconds"}`` for a periodic flush (the source's
timers).
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from emporia.functions.text import PATH_ARROW
from emporia.functions.time import DEFAULT_TZ, seconds_of_day, wall_clock
from emporia.operators.cumulate import DAY
from emporia.operators.ranking import top_n
from emporia.operators.sequence import transitions
from emporia.plans import gmv, logs
from emporia.sources.sinks import send_json
from emporia.streaming import store

# The per-user state function runs in Python workers, which may not have
# this package on their path; ship this module's functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _start(df: DataFrame, fn, checkpoint: str, mode: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    w = df.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stop_when_drained(query: StreamingQuery, timeout_s: float = 600.0, poll_s: float = 0.5) -> None:
    """Stop ``query`` once a batch finds no new input.  For queries whose
    state timeouts keep no-data batches coming (``processAllAvailable`` and
    ``availableNow`` do not return then)."""
    import time

    deadline = time.monotonic() + timeout_s
    while time.monotonic() < deadline:
        if query.exception():
            raise query.exception()
        p = query.lastProgress
        # A completed no-data batch (no new offset from any source, no input
        # rows) means the input is exhausted; with state timeouts one runs
        # every trigger.
        if p and p["sources"] and p["numInputRows"] == 0 and all(
            src.get("latestOffset") in (None, "None") for src in p["sources"]
        ):
            query.stop()
            return
        time.sleep(poll_s)
    query.stop()
    raise TimeoutError("stream did not drain in time")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators dropped as too late, in the batches
    that ``recentProgress`` still has."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])


def fail_on_drops(query: StreamingQuery) -> None:
    n = dropped_rows(query)
    if n:
        raise RuntimeError(f"{n} rows came later than the watermark allows and were dropped")


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


# ---- M1: page views ------------------------------------------------------------


def start_page_views(log_stream: DataFrame, out: str, checkpoint: str, tz: str = DEFAULT_TZ,
                     trigger: dict | None = None, lateness: str | None = None) -> StreamingQuery:
    """M1 on a stream: running PV per (log_date, log_type), ``update`` mode;
    with ``lateness`` a day's counts leave the state that long after the day.

    Read the result with ``store.latest(spark, out, ['log_date', 'log_type'])``.
    """
    counts = logs.page_views(log_stream, tz, lateness)
    return _start(counts, lambda b, e: store.append_latest(b, out, e, ["log_date", "log_type"]), checkpoint, "update", trigger, None)


# ---- M2: keyword Top-N, flushed per day ---------------------------------------------


def start_keyword_top_n(log_stream: DataFrame, out: str, checkpoint: str, n: int = 10, search_type: str = "search",
                        tz: str = DEFAULT_TZ, trigger: dict | None = None,
                        lateness: str | None = None) -> StreamingQuery:
    """True keyword counts kept by the streaming aggregate; each
    batch appends its updated counts to the touched days (``out/counts``),
    re-ranks only those days and overwrites their
    partitions of ``out/top`` (one current Top-N per day).  ``read_keyword_top_n``
    gives the sorted flush: days ascending, ranks within."""
    counts = logs.keyword_counts(log_stream, search_type, tz, lateness)
    count_path, top_path = f"{out}/counts", f"{out}/top"
    session = log_stream.sparkSession

    def flush(batch: DataFrame, epoch: int) -> None:
        cur = store.append_keyed(batch, count_path, "log_date", ["keyword"], epoch, session=session)
        if cur is None:
            return
        ranked = top_n(cur, ["log_date"], [F.desc("cnt"), F.asc("keyword")], n, "rn")
        (ranked.select("log_date", F.col("rn").cast("int").alias("rn"), "keyword", "cnt")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date").parquet(top_path))

    return _start(counts, flush, checkpoint, "update", trigger, None)


def read_keyword_top_n(spark, out: str) -> DataFrame:
    """The current Top-N of every day, sorted by day and rank."""
    return spark.read.parquet(f"{out}/top").select("log_date", "rn", "keyword", "cnt").orderBy("log_date", "rn")


# ---- M3: login regions -------------------------------------------------------------------


def start_login_regions(log_stream: DataFrame, ranges: DataFrame, out: str, checkpoint: str, login_type: str = "login",
                        tz: str = DEFAULT_TZ, trigger: dict | None = None, lateness: str | None = None) -> StreamingQuery:
    """M3/T14 on a stream: running logins per (log_date, full_region), earlier days
    included; ``ranges`` is a static table.  Read with ``store.latest``."""
    counts = logs.login_regions(log_stream, ranges, login_type, tz, lateness=lateness)
    return _start(counts, lambda b, e: store.append_latest(b, out, e, ["log_date", "full_region"]), checkpoint, "update", trigger, None)


# ---- M5: distinct device users ---------------------------------------------------------


def device_user_counts(log_stream: DataFrame, tz: str = DEFAULT_TZ, lateness: str | None = None) -> DataFrame:
    """M5/T13 on a stream: exact distinct users per (dt, plat, brand, platv).

    A direct streaming distinct count is not supported, so users are first
    deduplicated per day (``dropDuplicates`` state keyed by the day; with
    ``lateness`` a watermark on the day's start evicts it that long after
    the day) and then counted.
    """
    rows = logs.normalise(log_stream, tz).filter(
        F.col("device").isNotNull() & F.col("device.userkey").isNotNull() & F.col("device.plat").isNotNull()
    )
    rows = rows.select(
        F.col("log_date").cast("timestamp").alias("day_ts"),
        F.col("log_date").alias("dt"),
        F.col("device.plat").alias("plat"),
        F.col("device.brand").alias("brand"),
        F.col("device.platv").alias("platv"),
        F.col("device.userkey").alias("userkey"),
    )
    rows = rows.withWatermark("day_ts", lateness) if lateness else rows
    firsts = rows.dropDuplicates(["day_ts", "dt", "plat", "brand", "platv", "userkey"])
    return firsts.groupBy("day_ts", "dt", "plat", "brand", "platv").agg(F.count(F.lit(1)).alias("users")).drop("day_ts")


def start_device_users(log_stream: DataFrame, out: str, checkpoint: str, tz: str = DEFAULT_TZ,
                       trigger: dict | None = None, lateness: str | None = None) -> StreamingQuery:
    return _start(device_user_counts(log_stream, tz, lateness), lambda b, e: store.append_latest(b, out, e, logs.DEVICE), checkpoint,
                  "update", trigger, None)


# ---- M4: path transitions with per-user state -------------------------------------------

_TRANSITION_OUT = T.StructType([T.StructField("log_date", T.DateType()), T.StructField("path", T.StringType())])
_LAST_STATE = T.StructType(
    [T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("log_type", T.StringType())]
)


def _pairing(idle_ms: int | None):
    def pair(key, frames, state):
        if state.hasTimedOut:  # idle user: forget the last row
            state.remove()
            return
        yield from _pair_with_previous(key, frames, state)
        if idle_ms:
            state.setTimeoutDuration(idle_ms)

    return pair


def _pair_with_previous(key, frames, state):
    """Per user: order this batch's rows, pair each with the row before it
    (the last row of earlier batches comes from state), keep the last row."""
    pdf = pd.concat(list(frames), ignore_index=True).sort_values(["ts", "seq"], kind="stable")
    types = pdf["log_type"].reset_index(drop=True).astype(object)
    prev = types.shift(1)
    has_prev = pd.Series(True, index=types.index)
    if state.exists:
        prev.iloc[0] = state.get[2]
    else:
        has_prev.iloc[0] = False
    keep = has_prev & prev.notna() & types.notna() & (prev != types)
    last = pdf.iloc[-1]
    state.update((int(last["ts"]), int(last["seq"]), last["log_type"]))
    yield pd.DataFrame(
        {
            "log_date": pdf["log_date"].reset_index(drop=True)[keep],
            "path": prev[keep].astype(str) + PATH_ARROW + types[keep].astype(str),
        }
    )


def transition_rows(log_stream: DataFrame, tz: str = DEFAULT_TZ, seq: str | None = None,
                    idle_ms: int | None = None) -> DataFrame:
    """M4 on a stream: one row per page-type change.

    Rows are paired in (ts, seq) order within a micro-batch and in arrival
    order across batches; a row older than its user's last seen row is
    paired on arrival (the source paired by arrival window).  State holds
    one row per user; ``idle_ms`` drops it after that much processing time
    without rows for the user (the next row then starts a new path).  With
    a timeout, run the query on a processing-time trigger and end it with
    ``stop_when_drained``: pending timeouts keep ``availableNow`` and
    ``processAllAvailable`` from returning.
    """
    rows = logs.normalise(log_stream, tz)
    rows = rows.select("user_id", "ts", (F.col(seq) if seq else F.lit(0)).cast("long").alias("seq"), "log_type",
                       "log_date")
    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy("user_id").applyInPandasWithState(
        _pairing(idle_ms), _TRANSITION_OUT, _LAST_STATE, "append", timeout
    )


def touched_rows(spark, out: str, batch: DataFrame, epoch: int):
    """Stored rows of the users and days that ``batch`` has rows of, this batch's included.
    Only the folders of those days and users' parts are read."""
    folders = batch.groupBy("log_date").agg(F.collect_set("user_part").alias("parts")).collect()
    rows = spark.read.parquet(f"{out}/rows")
    where = F.lit(False)
    for f in folders:
        where = where | ((F.col("log_date") == F.lit(f["log_date"])) & F.col("user_part").isin(f["parts"]))
    users = batch.select("log_date", "user_part", "user_id").distinct()
    return rows.filter(where & (F.col(store.EPOCH) <= epoch)).join(users, ["log_date", "user_part", "user_id"], "left_semi")


def start_path_transitions(log_stream: DataFrame, out: str, checkpoint: str, tz: str = DEFAULT_TZ,
                           seq: str | None = None, trigger: dict | None = None, user_parts: int = 8) -> StreamingQuery:
    """M4 on a stream, the same as in batch whatever order rows arrive in.

    Each batch stores its rows by day and ``user_parts`` of the users (``out/rows``; more
    where a day has many rows and a batch few users) and looks again
    at the days of the users it has rows of: by how much their transitions differ from
    those without the batch (``out/inside``, to be summed), and the users' first and last
    rows of the day (``out/edges``, the latest counts).  Read with
    ``read_path_transitions``, which joins the days of a user from their edges.  A batch
    writes below its own number and compares with the batches before it, so a replayed
    batch changes nothing.  Rows without a user have no path.
    """
    rows = logs.normalise(log_stream.filter(F.col("user_id").isNotNull()), tz).select(
        "user_id", "ts", (F.col(seq) if seq else F.lit(0)).cast("long").alias("seq"), "log_type", "log_date",
        F.pmod(F.xxhash64("user_id"), F.lit(user_parts)).cast("int").alias("user_part"),
    )

    def inside(stored: DataFrame) -> DataFrame:
        keyed = stored.withColumn("user_day", F.struct("user_id", "log_date"))
        return logs.count_moves(transitions(keyed, "user_day", ["ts", "seq"], "log_type", F.floor(F.col("ts") / 3_600_000)))

    def flush(batch: DataFrame, epoch: int) -> None:
        store.append_epoch(batch.repartition("log_date", "user_part"), f"{out}/rows", epoch, ("log_date", "user_part"))
        own = batch.sparkSession.read.parquet(f"{out}/rows").filter(F.col(store.EPOCH) == epoch)
        if own.isEmpty():
            return
        stored = touched_rows(batch.sparkSession, out, own, epoch)
        edge = F.struct("ts", "seq", "log_type")
        edges = stored.groupBy("user_id", "log_date").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
        before = inside(stored.filter(F.col(store.EPOCH) < epoch)).withColumn("cnt", -F.col("cnt"))
        change = inside(stored).unionByName(before).groupBy("log_date", "path").agg(F.sum("cnt").alias("cnt")).filter("cnt <> 0")
        for df, name in ((edges, "edges"), (change, "inside")):
            store.append_epoch(df, f"{out}/{name}", epoch, ("log_date",))

    return _start(rows, flush, checkpoint, "append", trigger, None)


def read_path_transitions(spark, out: str) -> DataFrame:
    """Counts per (log_date, path), sorted by day, falling count and path."""
    inside = store.summed(spark, f"{out}/inside", ["log_date", "path"], ["cnt"])
    day = Window.partitionBy("user_id").orderBy("log_date")
    edges = store.latest(spark, f"{out}/edges", ["user_id", "log_date"]).withColumn("prev", F.lag("last").over(day)["log_type"])
    across = logs.count_moves(edges.select("log_date", "prev", F.col("first.log_type").alias("log_type")))
    total = inside.select("log_date", "path", "cnt").unionByName(across).groupBy("log_date", "path").agg(F.sum("cnt").alias("cnt"))
    return total.filter("cnt <> 0").orderBy("log_date", F.desc("cnt"), "path")


# ---- T1-T5: cumulative GMV report ---------------------------------------------------------


def pane_stream(sales: DataFrame, time_col: str = "event_time", amount_col: str = "total_amount", id_col: str = "id",
                product_col: str = "product_id", step_s: int = 600, watermark: str | None = None) -> DataFrame:
    """T6 + A6 on a stream: amount per (10-minute pane, id, product).

    ``time_col`` is wall-clock TIMESTAMP_NTZ; the pane is an event-time window on its
    session-time-zone instant.  With ``watermark`` a pane's state is dropped once the
    watermark passes its end, and rows that come later are lost.
    """
    et = F.col(time_col).cast("timestamp")
    amt = F.col(amount_col).cast("decimal(18,2)")
    rows = sales.select(et.alias("_et"), amt.alias("amt"), id_col, product_col)
    rows = rows.withWatermark("_et", watermark) if watermark else rows
    return rows.groupBy(F.window("_et", f"{step_s} seconds").alias("_w"), id_col, product_col).agg(
        F.sum("amt").alias("amt")
    )


def start_gmv_report(sales: DataFrame, out: str, checkpoint: str, id_col: str = "id", product_col: str = "product_id",
                     n: int = 5, step_s: int = 600, watermark: str | None = None, time_col: str = "event_time",
                     amount_col: str = "total_amount", trigger: dict | None = None, tz: str | None = None,
                     day: str | None = None, ops: tuple[str, ...] | None = None,
                     json_sink: dict | None = None) -> StreamingQuery:
    """T2-T5 on a stream.  Updated pane totals are appended by day to
    ``out/panes``; the touched days' cumulative rows are recomputed from
    their latest totals and overwrite those days in
    ``out/report`` (partitioned by order_date).  A late row corrects every
    later window of its day.

    ``time_col`` may be an instant (as ``read_sales_stream`` gives it), which is cut
    into days and panes by its wall clock in ``tz`` (default: the session's), or
    a wall clock already.  ``day`` and ``ops`` keep one day and some change ops.  With
    ``json_sink`` (as for ``sinks.send_json``) the touched days' rows also go out as
    JSON."""
    if isinstance(sales.schema[time_col].dataType, T.TimestampType):
        sales = sales.withColumn(time_col, wall_clock(time_col, tz or _session_tz(sales)))
    sales = gmv.prepare_sales(sales, time_col, day, ops)
    panes = pane_stream(sales, time_col, amount_col, id_col, product_col, step_s, watermark)
    pane_path, report_path = f"{out}/panes", f"{out}/report"
    keys = ["window_start", "pane", id_col, product_col]
    session = sales.sparkSession

    def flush(batch: DataFrame, epoch: int) -> None:
        start = wall_clock(F.col("_w.start"), _session_tz(batch))
        rows = batch.select(
            F.to_date(start).cast("timestamp_ntz").alias("window_start"),
            (F.floor(seconds_of_day(start) / step_s) + 1).cast("int").alias("pane"),
            id_col,
            product_col,
            "amt",
        ).withColumn("day", F.to_date("window_start"))
        cur = store.append_keyed(rows, pane_path, "day", keys, epoch, session=session)
        if cur is None:
            return
        report = gmv.report_from_panes(cur.drop("day"), id_col, product_col, n, step_s, DAY)
        # A day's rows, one a window, go to one file.
        (report.repartition("order_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("order_date").parquet(report_path))
        if json_sink:
            days = store.written(session, pane_path, "day", epoch)
            send_json(read_gmv_report(session, out, n).filter(F.col("order_date").isin(days)), json_sink)

    return _start(panes, flush, checkpoint, "update", trigger, None)


def read_gmv_report(spark, out: str, n: int = 5) -> DataFrame:
    """The stream's report table with its columns and types as in batch
    (``order_date`` is the partition folder, read back as text)."""
    df = spark.read.parquet(f"{out}/report")
    return df.select(
        F.col("order_date").cast("string").alias("order_date"),
        "window_start", "window_end", "gmv", f"top{n}_ids", f"top{n}_product_ids",
    )


# ---- C4: current state from a change stream --------------------------------------------------


def start_current_state(flat_changes: DataFrame, out: str, checkpoint: str, keys: list[str],
                        order: tuple[str, ...] = ("ts_ms", "lsn"), trigger: dict | None = None) -> StreamingQuery:
    """C4 on a stream: each batch keeps its latest change per key; readers
    take the latest over all batches by (ts_ms, lsn), so changes that
    arrive out of order still resolve correctly, and drop deletes."""

    def flush(batch: DataFrame, epoch: int) -> None:
        from emporia.operators.ranking import latest_by

        store.append_latest(latest_by(batch, keys, list(order)), out, epoch, keys, list(order))

    return _start(flat_changes, flush, checkpoint, "append", trigger, None)


def read_current_state(spark, out: str, keys: list[str], order: tuple[str, ...] = ("ts_ms", "lsn")) -> DataFrame:
    return store.latest(spark, out, keys, list(order)).filter(F.col("op") != "d")


__all__ = [
    "device_user_counts",
    "dropped_rows",
    "fail_on_drops",
    "read_current_state",
    "read_gmv_report",
    "read_keyword_top_n",
    "read_path_transitions",
    "start_current_state",
    "start_device_users",
    "start_gmv_report",
    "start_keyword_top_n",
    "start_login_regions",
    "start_page_views",
    "start_path_transitions",
    "stop_when_drained",
    "transition_rows",
]
