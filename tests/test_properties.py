"""Properties of the flagship report on the driver data, and
the remaining sink/trigger/namespace helpers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.plans import gmv, inputs
from emporia.sources import sinks, tables
from emporia.streaming import jobs, store

SMALL = "/root/testdata/sf0.001"


def test_gmv_report_properties(spark):
    sales = inputs.sales_events(spark, SMALL)
    rep = gmv.gmv_topn_report(sales)
    w = Window.partitionBy("window_start").orderBy("window_end")
    checked = rep.withColumn("prev", F.lag("gmv").over(w))
    # Purchases are non-negative, so cumulative GMV never decreases.
    assert checked.filter(F.col("gmv") < F.col("prev")).count() == 0
    # The day's last window equals the day's total.
    last = rep.groupBy("window_start").agg(F.max_by("gmv", "window_end").alias("last"))
    totals = sales.groupBy(F.to_date("event_time").cast("timestamp_ntz").alias("window_start")).agg(
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("total")
    )
    assert last.join(totals, "window_start").filter(F.col("last") != F.col("total")).count() == 0
    assert last.count() == totals.count()
    # Lists hold at most five ids, none repeated.
    for c in ("top5_ids", "top5_product_ids"):
        arr = F.split(F.col(c), ",")
        assert rep.filter((F.size(arr) > 5) | (F.size(F.array_distinct(arr)) != F.size(arr))).count() == 0
    # Every day has a row for every window end from its first event to midnight.
    per_day = rep.groupBy("window_start").agg(F.min("window_end").alias("lo"), F.count("*").alias("n"))
    gaps = per_day.filter(
        F.col("n") != (F.unix_seconds(F.col("window_start").cast("timestamp") + F.expr("INTERVAL 1 DAY"))
                       - F.unix_seconds(F.col("lo").cast("timestamp"))) / 600 + 1
    )
    assert gaps.count() == 0


def test_console_sink_and_processing_time_trigger(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"ts": 1700000000, "log_type": "home"}\n{"ts": 1700000001, "log_type": "cart"}\n')
    from emporia.sources import streams

    logs_s = streams.read_log_stream(spark, {"format": "text", "path": str(src)})
    out, ck = str(tmp_path / "pv"), str(tmp_path / "ck")
    q = jobs.start_page_views(logs_s, out, ck, trigger={"processingTime": "1 second"})
    q.processAllAvailable()
    q.stop()
    assert store.latest(spark, out, ["log_date", "log_type"]).count() == 2
    c = sinks.to_console(logs_s.groupBy("log_type").count(), "complete").trigger(availableNow=True).start()
    c.awaitTermination()
    assert c.exception() is None


def test_use_database_and_catalog_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS report_db")
    spark.range(3).write.mode("overwrite").saveAsTable("report_db.t")
    tables.use_database(spark, "report_db")
    try:
        assert spark.catalog.currentDatabase() == "report_db"
        assert tables.catalog_table(spark, "t").count() == 3
        assert tables.catalog_table(spark, "report_db.t", ["id"]).count() == 3
    finally:
        tables.use_database(spark, "default")
