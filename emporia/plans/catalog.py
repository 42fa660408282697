"""Registry of named queries over the driver tables: name -> (spark, base) -> DataFrame.

Each entry reads whole tables (or data Spark derives from them) so its
work grows with the input.  Oracle SQL for the same names is in
``oracle/queries.py``.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions import time as tfn
from emporia.operators.joins import ip_binary, ip_region_join, null_safe_on
from emporia.plans import changes, gmv, inputs, links, logs, ods, reports
from emporia.plans import warehouse as wh
from emporia.session import scratch_path
from emporia.sources import landing, sinks
from emporia.sources import tables as tbl
from emporia.sources.streams import read_sales_stream
from emporia.sources.tables import table
from emporia.streaming import final, jobs, keyed, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


# ---- T1-T5: cumulative GMV and Top-5 -------------------------------------


@query("gmv_topn_report")
def q_gmv_topn_report(spark, base):
    return gmv.gmv_topn_report(inputs.sales_events(spark, base))


@query("cumulative_gmv")
def q_cumulative_gmv(spark, base):
    return gmv.cumulative_gmv(inputs.sales_events(spark, base))


@query("cumulative_top_ids")
def q_cumulative_top_ids(spark, base):
    return gmv.cumulative_top(inputs.sales_events(spark, base), "id", name="top5_ids")


@query("cumulative_top_products")
def q_cumulative_top_products(spark, base):
    return gmv.cumulative_top(inputs.sales_events(spark, base), "product_id", name="top5_product_ids")


# ---- E1-E4: epoch handling -------------------------------------------------


@query("epoch_normalise")
def q_epoch_normalise(spark, base):
    rows = logs.normalise(inputs.log_events(spark, base))
    return rows.select(
        "event_id",
        F.col("ts").alias("ts_ms"),
        "log_date",
        tfn.local_time_str("ts").alias("log_time"),
    )


@query("event_time_parse")
def q_event_time_parse(spark, base):
    return inputs.sales_strings(spark, base).select(
        "event_id", tfn.wall_clock(tfn.event_time("ts", "insert_time"), "UTC").alias("event_time")
    )


# ---- M1-M5: behaviour-log metrics --------------------------------------------


@query("page_views")
def q_page_views(spark, base):
    return logs.page_views(inputs.log_events(spark, base))


@query("keyword_top10")
def q_keyword_top10(spark, base):
    return logs.keyword_top_n(inputs.log_events(spark, base), 10, search_type="click")


@query("login_regions")
def q_login_regions(spark, base):
    return logs.login_regions(inputs.log_events(spark, base), inputs.ip_ranges(spark, base), login_type="signup")


@query("path_transitions")
def q_path_transitions(spark, base):
    return logs.path_transitions(inputs.log_events(spark, base), order=("ts", "event_id"))


@query("device_users")
def q_device_users(spark, base):
    return logs.device_users(inputs.log_events(spark, base))


@query("page_view_lines")
def q_page_view_lines(spark, base):
    """The source's day windows and printed lines."""
    return logs.page_view_windows(inputs.log_events(spark, base))


# ---- A2, A4, A5: running results, one row per input ----------------------------


@query("keyword_running_counts")
def q_keyword_running_counts(spark, base):
    return logs.keyword_running_counts(inputs.log_events(spark, base), ("ts", "event_id"), search_type="click")


@query("path_running_counts")
def q_path_running_counts(spark, base):
    return logs.path_running_counts(inputs.log_events(spark, base), ("ts", "event_id"))


@query("device_user_arrivals")
def q_device_user_arrivals(spark, base):
    return logs.device_user_arrivals(inputs.log_events(spark, base), ("ts", "event_id"))


# ---- J8: addresses in overlapping ranges ------------------------------------------


@query("ip_interval_lookup")
def q_ip_interval_lookup(spark, base):
    return ip_region_join(inputs.address_rows(spark, base).drop("ip6"), "ip", inputs.wide_ranges(spark, base))


@query("ip_interval_lookup_v6")
def q_ip_interval_lookup_v6(spark, base):
    rows = inputs.address_rows(spark, base).select("event_id", ip_binary("ip6").alias("ip"))
    return ip_region_join(rows, "ip", inputs.wide_ranges_v6(spark, base)).select("event_id", F.lower(F.hex("ip")).alias("ip"), "region")


# ---- R1-R5: report SQL over the GMV report table ----------------------------


def _report(spark, base):
    """The report table; every query below reads it once or twice."""
    return inputs.report_table(gmv.gmv_topn_report(inputs.sales_events(spark, base)))


@query("latest_snapshot")
def q_latest_snapshot(spark, base):
    return reports.latest_snapshot(_report(spark, base)).select("ds", "window_end", "win_gmv", "top5_product_ids")


@query("top5_products")
def q_top5_products(spark, base):
    return reports.top_products(_report(spark, base), inputs.product_detail(spark, base))


@query("growth")
def q_growth(spark, base):
    return reports.growth(_report(spark, base), inputs.product_detail(spark, base))


@query("repeat_rate")
def q_repeat_rate(spark, base):
    return reports.repeat_rate(_report(spark, base), inputs.product_detail(spark, base))


@query("repeat_rate_desc")
def q_repeat_rate_desc(spark, base):
    return reports.repeat_rate(_report(spark, base), inputs.product_detail(spark, base), with_prev_descs=True)


# ---- C1-C4: change data -------------------------------------------------------


CHANGE_ROW = inputs.CHANGE_ROW


def _flat_changes(spark, base):
    env = changes.filter_tables(changes.parse_changes(inputs.change_log(spark, base), CHANGE_ROW), "public", "events")
    return changes.flatten_change(env, CHANGE_ROW)


@query("change_flatten")
def q_change_flatten(spark, base):
    return _flat_changes(spark, base)


@query("change_current_state")
def q_change_current_state(spark, base):
    return changes.current_state(_flat_changes(spark, base), ["user_id"])


def _handover(spark, base):
    """The users' rows at a log position as the snapshot, and the whole log, which overlaps
    it: C2 and S4."""
    at = inputs.taken_at(spark, base)
    log = changes.parse_changes(inputs.change_log(spark, base), CHANGE_ROW)
    earlier = changes.flatten_change(log.filter(F.col("source.lsn") <= at), CHANGE_ROW)
    snapshot = changes.current_state(earlier, ["user_id"]).select(*CHANGE_ROW.names)
    both = changes.handover([(snapshot, "public", "events", at)], log)
    return changes.flatten_change(changes.filter_tables(both, "public", "events"), CHANGE_ROW)


@query("change_handover")
def q_change_handover(spark, base):
    """C2/S4 through C3 and C1: the snapshot's rows, then the changes behind it."""
    return _handover(spark, base)


@query("change_handover_state")
def q_change_handover_state(spark, base):
    return changes.current_state(_handover(spark, base), ["user_id"]).select("user_id", "event_type", "value")


# ---- S7: incremental landing -------------------------------------------------------


@query("ods_incremental_users")
def q_ods_incremental_users(spark, base):
    """Each user's last event, landed in two loads, the second of them twice: its full day."""
    dest = scratch_path(spark, f"ods-{uuid.uuid4().hex}")
    rows = inputs.events(spark, base).select("user_id", "event_id", "event_type", "value", (F.col("event_type") == "error").alias("gone"))
    first = rows.filter(F.col("event_id") <= inputs.taken_at(spark, base))
    for source, dt in ((first, "2024-01-15"), (rows, "2024-01-16"), (rows, "2024-01-16")):
        landing.land_increment(source, dest, dt, ["user_id"], "event_id", deleted="gone")
    return landing.read_full(spark, dest, "2024-01-16").drop("gone")


# ---- H1-H32: layered warehouse --------------------------------------------------


AS_OF = "2024-01-31"
MONTH = "2024-01"
DRILL_DAY = "2024-01-15"


class Layers:
    """The warehouse layers over one set of driver tables (plans only; no
    query runs until an action)."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base

    @functools.cached_property
    def _sku(self):
        s = self.spark, self.base
        return wh.dim_sku(ods.ods_sku_info(*s), ods.ods_base_category3(*s), ods.ods_inventory(*s))

    def sku(self):
        return self._sku

    @functools.cached_property
    def _users(self):
        return wh.dim_user(ods.ods_user_info(self.spark, self.base), AS_OF)

    def users(self):
        return self._users

    def orders(self):
        return ods.ods_order_info(self.spark, self.base)

    def lines(self):
        return ods.ods_order_detail(self.spark, self.base)

    def detail(self):
        s = self.spark, self.base
        return wh.dwd_order_detail(self.lines(), self.orders(), ods.ods_payment_info(*s), self.sku())

    def page_log(self):
        return wh.dwd_page_log(ods.ods_page_log(self.spark, self.base), self.sku())

    def comments(self):
        return wh.dwd_comment_detail(ods.ods_comment_info(self.lines(), self.orders()))

    def sku_sales(self):
        return wh.dws_sku_sales_day_sum(self.detail())

    def comment_sum(self):
        return wh.dws_comment_day_sum(self.comments())

    def conversion(self):
        return wh.sales_metrics(self.page_log(), self.sku_sales())


class StoredLayers(Layers):
    """The layers as stored tables: DWD, DWS and ADS tables are landed by ``dt`` below the
    shared folder, and the next layer reads them back, pruned to the days it needs."""

    @functools.cached_property
    def root(self):
        return scratch_path(self.spark, f"warehouse-{uuid.uuid4().hex}")

    def _land(self, layer, name, df):
        # Rebalanced by day: large days are split into several files, small tasks merged.
        path = sinks.write_layer(df.hint("rebalance", "dt"), self.root, layer, name)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    @functools.cached_property
    def _detail(self):
        return self._land("dwd", "dwd_order_detail", super().detail())

    def detail(self):
        return self._detail

    @functools.cached_property
    def _page_log(self):
        return self._land("dwd", "dwd_page_log", super().page_log())

    def page_log(self):
        return self._page_log

    def comments(self):
        return self._land("dwd", "dwd_comment_detail", super().comments())

    @functools.cached_property
    def _sku_sales(self):
        return self._land("dws", "dws_sku_sales_day_sum", super().sku_sales())

    def sku_sales(self):
        return self._sku_sales

    def comment_sum(self):
        return self._land("dws", "dws_comment_day_sum", super().comment_sum())

    def conversion(self):
        return self._land("ads", "ads_sku_conversion_sales_day", super().conversion())


class NullLayers(Layers):
    """The same layers over a page log with derived nulls: no user in every 13th
    second, no sku (nor its shop, category and brand) in every 17th."""

    def page_log(self):
        log, second = super().page_log(), F.second("ts")
        sku = ["sku_id", "store_id", "category3_id", "brand"]
        return log.withColumn("user_id", F.when(second % 13 != 0, F.col("user_id"))).withColumns(
            {c: F.when(second % 17 != 0, F.col(c)) for c in sku}
        )


def _wh(fn, layers=Layers):
    return lambda spark, base: fn(layers(spark, base))


WAREHOUSE = {
    "dim_sku": lambda L: L.sku(),
    "dim_user": lambda L: L.users(),
    "dwd_order_detail": lambda L: L.detail(),
    "dwd_order_info": lambda L: wh.dwd_order_info(L.orders(), L.lines(), ods.ods_payment_info(L.spark, L.base)),
    "dwd_payment_info": lambda L: wh.dwd_payment_info(ods.ods_payment_info(L.spark, L.base), L.orders()),
    "dwd_log_detail": lambda L: L.page_log(),
    "dwd_comment_detail": lambda L: L.comments(),
    "dwd_cart_detail": lambda L: wh.dwd_action_detail(L.page_log(), "click"),
    "dwd_favor_detail": lambda L: wh.dwd_action_detail(L.page_log(), "signup"),
    "dws_user_action_day_sum": lambda L: wh.dws_user_action_day_sum(L.page_log()),
    "dws_order_day_sum": lambda L: wh.dws_order_day_sum(L.detail()),
    "dws_sku_sales_day_sum": lambda L: L.sku_sales(),
    "dws_comment_day_sum": lambda L: L.comment_sum(),
    "dws_favor_day_sum": lambda L: wh.dws_favor_day_sum(wh.dwd_action_detail(L.page_log(), "signup")),
    "dws_store_category_daycount": lambda L: wh.dws_store_category_daycount(L.page_log(), L.detail()),
    "dws_attr_distribution_analysis": lambda L: wh.dws_attr_distribution_analysis(L.page_log(), L.detail(), L.sku()),
    "dws_store_source_daycount": lambda L: wh.dws_store_source_daycount(L.page_log()),
    "dws_store_user_daycount": lambda L: wh.dws_store_audience_daycount(L.detail(), L.users(), "user_type"),
    "dws_store_age_daycount": lambda L: wh.dws_store_audience_daycount(L.detail(), L.users(), "age_band"),
    "dws_store_gender_daycount": lambda L: wh.dws_store_audience_daycount(L.detail(), L.users(), "gender"),
    "dws_keyword_traffic_analysis": lambda L: wh.dws_keyword_traffic_analysis(L.page_log()),
    "sales_metrics": lambda L: L.conversion(),
    "traffic_metrics": lambda L: wh.traffic_metrics(L.page_log()),
    "channel_pivot": lambda L: wh.channel_pivot(L.page_log()),
    "price_metrics": lambda L: wh.price_metrics(L.sku_sales(), L.conversion()),
    "customer_insight": lambda L: wh.customer_insight(L.page_log(), L.users()),
    "core_summary": lambda L: wh.core_summary(wh.dws_store_category_daycount(L.page_log(), L.detail())),
    "product_ranking": lambda L: wh.product_ranking(L.detail()),
    "gmv_target_progress": lambda L: wh.gmv_target_progress(
        L.detail(), wh.gmv_targets(L.spark, ods.ods_store_info(L.spark, L.base), MONTH)
    ),
    "gmv_contribution": lambda L: wh.gmv_contribution(L.detail()),
    "category_rank": lambda L: wh.category_rank(L.detail(), MONTH),
    "source_share": lambda L: wh.source_share(wh.dws_store_source_daycount(L.page_log())),
    "audience_ratio": lambda L: wh.audience_ratio(L.page_log(), L.users()),
    "ads_wide": lambda L: wh.ads_wide(L.sku_sales(), L.comment_sum(), L.conversion()),
    "one_shot_ads": lambda L: wh.one_shot_ads(L.page_log(), L.detail(), L.comments()),
    "drilldown_summary": lambda L: wh.drilldown_summary(L.detail()),
    "drilldown_detail": lambda L: wh.drilldown_detail(L.detail(), DRILL_DAY),
}


def _span(L, day_table, count):
    """Visitors of a span of days by store and source, from the stored day table alone."""
    dims = ["store_id", "source_type"]
    stored = L._land("dws", day_table.__name__, day_table(L.page_log(), dims))
    return count(stored, dims, *SPAN)


def _visitors_checked(L):
    """The sketches' counts beside the exact ones: whether they are within 2 %, or 1."""
    about = _span(L, wh.dws_visitor_sketch_day, wh.visitors_about).withColumnRenamed("visitors", "about")
    exact = _span(L, wh.dws_visitor_bitmap_day, wh.visitors_exactly)
    both = null_safe_on(exact, about, ["store_id", "source_type"], "full_outer")
    close = F.abs(F.col("about") - F.col("visitors")) <= F.greatest(F.lit(1.0), F.col("visitors") * 0.02)
    return both.select("store_id", "source_type", "visitors", close.alias("sketch_close"))


SPAN = ("2024-01-08", "2024-01-21")
WAREHOUSE["visitor_span"] = lambda L: _span(L, wh.dws_visitor_bitmap_day, wh.visitors_exactly)
WAREHOUSE["visitor_span_sketch"] = _visitors_checked
for _name, _fn in WAREHOUSE.items():
    QUERIES[_name] = _wh(_fn)
for _name in ["ads_wide", "price_metrics", "drilldown_summary", "drilldown_detail", "visitor_span", "visitor_span_sketch"]:
    QUERIES[_name] = _wh(WAREHOUSE[_name], StoredLayers)
for _name in ["ads_wide", "one_shot_ads", "audience_ratio", "dws_store_source_daycount", "dws_store_category_daycount"]:
    QUERIES[f"{_name}_nulls"] = _wh(WAREHOUSE[_name], NullLayers)


# ---- G5/A14/F23: links from stored pages ------------------------------------------


@query("page_links")
def q_page_links(spark, base):
    pages = table(spark, base, "pages", ["page_id", "url", "html"])
    # The driver's pages carry neither target nor title attributes.
    return links.page_links(pages, require_blank_target=False, require_title=False)


@query("page_links_strict")
def q_page_links_strict(spark, base):
    """The source's own rule.  On pages with an even id the anchors get what it asks
    for, behind another element and beside misleading attributes."""
    pages = table(spark, base, "pages", ["page_id", "url", "html"])
    full = F.replace("html", F.lit("<li><a href="), F.lit("<LI class='x'><span>-</span><A target='_blank' data-href=\"/wrong\" title=\"T\" HREF="))
    return links.page_links(pages.withColumn("html", F.when(F.col("page_id") % 2 == 0, full).otherwise(F.col("html"))))


# ---- T6-T14: the same pipelines as streams (file stream of events) ------------------


def _stream(spark, starter, reader):
    """Drain the stream once (availableNow) into a fresh folder of the
    shared checkpoint area and read its result table."""
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    q = starter(f"{root}/out", f"{root}/checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    jobs.fail_on_drops(q)
    return reader(f"{root}/out")


@query("stream_page_views")
def q_stream_page_views(spark, base):
    logs_s = inputs.log_rows(inputs.events_stream(spark, base))
    return _stream(spark, lambda o, c: jobs.start_page_views(logs_s, o, c),
                   lambda o: store.latest(spark, o, ["log_date", "log_type"]))


@query("stream_keyword_top10")
def q_stream_keyword_top10(spark, base):
    logs_s = inputs.log_rows(inputs.events_stream(spark, base))
    return _stream(spark, lambda o, c: jobs.start_keyword_top_n(logs_s, o, c, 10, "click"),
                   lambda o: jobs.read_keyword_top_n(spark, o))


@query("stream_login_regions")
def q_stream_login_regions(spark, base):
    logs_s = inputs.log_rows(inputs.events_stream(spark, base))
    return _stream(spark, lambda o, c: jobs.start_login_regions(logs_s, inputs.ip_ranges(spark, base), o, c, "signup"),
                   lambda o: store.latest(spark, o, ["log_date", "full_region"]))


@query("stream_device_users")
def q_stream_device_users(spark, base):
    logs_s = inputs.log_rows(inputs.events_stream(spark, base))
    return _stream(spark, lambda o, c: jobs.start_device_users(logs_s, o, c),
                   lambda o: store.latest(spark, o, ["dt", "plat", "brand", "platv"]))


@query("stream_path_transitions")
def q_stream_path_transitions(spark, base):
    logs_s = inputs.log_rows(inputs.events_stream(spark, base))
    return _stream(spark, lambda o, c: jobs.start_path_transitions(logs_s, o, c, seq="event_id"),
                   lambda o: jobs.read_path_transitions(spark, o))


@query("stream_gmv_topn_report")
def q_stream_gmv_topn_report(spark, base):
    sales_s = inputs.sales_rows(inputs.events_stream(spark, base))
    return _stream(spark, lambda o, c: jobs.start_gmv_report(sales_s, o, c),
                   lambda o: jobs.read_gmv_report(spark, o))


@query("stream_sales_report")
def q_stream_sales_report(spark, base):
    """Sales rows as JSON lines, read back as the sales stream in several
    micro-batches, reported by the wall clock in Shanghai for live ops, Top-3."""
    folder = scratch_path(spark, f"sales-{uuid.uuid4().hex}")
    # Three batches at any size, of files of about a million rows.
    files = 1 + inputs.events(spark, base).count() // 3_000_000
    inputs.sales_json(spark, base).repartition(3 * files, "value").write.text(folder)
    sales = read_sales_stream(spark, {"format": "text", "path": folder, "maxFilesPerTrigger": files})
    return _stream(
        spark,
        lambda o, c: jobs.start_gmv_report(sales, o, c, n=3, tz="Asia/Shanghai", ops=gmv.LIVE_OPS, json_sink={"path": f"{o}/json"}),
        lambda o: jobs.read_gmv_report(spark, o, 3),
    )


@query("stream_change_current_state")
def q_stream_change_current_state(spark, base):
    env = changes.parse_changes(inputs.change_rows(inputs.events_stream(spark, base)), CHANGE_ROW)
    flat = changes.flatten_change(changes.filter_tables(env, "public", "events"), CHANGE_ROW)
    return _stream(spark, lambda o, c: jobs.start_current_state(flat, o, c, ["user_id"]),
                   lambda o: jobs.read_current_state(spark, o, ["user_id"]))


# ---- streams that write each result once, or one for each input ----------------------


def _in_lots(spark, rows, lot, count, starter):
    """Rows land in ``count`` lots; after each the stream goes on from its checkpoint and
    stops.  Returns the folder of its results."""
    root = scratch_path(spark, f"lots-{uuid.uuid4().hex}")
    for k in range(count):
        rows.filter(F.col(lot) == k).drop(lot).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.drop(lot).schema).parquet(f"{root}/in")
        q = starter(stream, f"{root}/out", f"{root}/checkpoint")
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return f"{root}/out"


@query("stream_gmv_final")
def q_stream_gmv_final(spark, base):
    """Only windows that the watermark has closed, each written once; late rows count
    in the windows of their day that are still open."""
    out = _in_lots(spark, inputs.sales_lots(spark, base), "lot", inputs.LOTS, final.start_gmv_final)
    return final.read_gmv_final(spark, out)


@query("stream_arrival_paths")
def q_stream_arrival_paths(spark, base):
    """Paths by time of arrival, flushed every 15 seconds, with the printed line."""
    rows = inputs.arrival_logs(spark, base).withColumn("lot", F.when(F.col("event_id") < 0, 1).otherwise(0))
    out = _in_lots(spark, rows, "lot", 2, lambda s, o, c: final.start_arrival_paths(s, o, c, seq="event_id"))
    return final.read_arrival_paths(spark, out)


@query("stream_keyword_daily_once")
def q_stream_keyword_daily_once(spark, base):
    """List state and a timer, a day's Top-10 given once."""
    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    q = keyed.start_keyword_once(inputs.log_rows(inputs.events_stream(spark, base)), f"{root}/out", f"{root}/checkpoint", 10, "click", wait_s=1.0)
    keyed.stop_when_quiet(q, quiet_s=4.0)
    return keyed.read_keyword_once(spark, f"{root}/out", 10)


@query("stream_device_user_arrivals")
def q_stream_device_user_arrivals(spark, base):
    """A row per new user, state kept by day, over two lots and a restart."""
    rows = inputs.log_events(spark, base).withColumn("lot", F.when(F.col("event_id") <= inputs.taken_at(spark, base), 0).otherwise(1))
    out = _in_lots(spark, rows, "lot", 2, lambda s, o, c: keyed.start_device_user_arrivals(s, o, c, seq="event_id"))
    return keyed.read_device_user_arrivals(spark, out).withColumnRenamed("seq", "event_id")


@query("stream_page_view_lines")
def q_stream_page_view_lines(spark, base):
    """T7/F21 on a stream, running counts by day window."""
    lines = logs.page_view_windows(inputs.log_rows(inputs.events_stream(spark, base)))
    return _stream(spark, lambda o, c: jobs._start(lines, lambda b, e: store.append_epoch(b, o, e), c, "update", None, None),
                   lambda o: store.latest(spark, o, ["log_date", "log_type"]))


# ---- E10-E12, S11-S12: views, preview and full scan -------------------------------


@query("daily_sales")
def q_daily_sales(spark, base):
    """E10-E12 on one day: live change rows (r, +I, +U) of the sales table
    as the 8-column view.  op by event type: purchase r, view +I, click +U,
    signup -U, error -D."""
    ev = inputs.events(spark, base)
    op = F.create_map(*[F.lit(x) for kv in inputs.SALES_OPS.items() for x in kv])[F.col("event_type")]
    sales = ev.select(
        F.col("event_id").cast("string").alias("id"),
        (F.col("event_id") * 7).cast("string").alias("order_id"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_name"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.lit(1).cast("long").alias("sale_num"),
        F.col("value").cast("decimal(10,2)").alias("total_amount"),
        F.col("ts").alias("event_time"),
        op.alias("op"),
    )
    return gmv.daily_sales(sales, inputs.SALES_DAY)


@query("preview")
def q_preview(spark, base):
    """The first 100 report rows in a stated order."""
    return tbl.preview(gmv.gmv_topn_report(inputs.sales_events(spark, base)), ["window_start", "window_end"], 100)


@query("scan")
def q_scan(spark, base):
    """Full scan of the log message table."""
    return tbl.scan(spark, base, "events")
