import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from emporia.functions.time import daily_window, day_window_offset
from emporia.plans import ods
from emporia.schemas import LOG_EVENT
from emporia.sources import jdbc, sinks, streams

SMALL = "/root/testdata/sf0.001"


def test_parse_json_modes(spark):
    df = spark.createDataFrame([('{"ts": 1, "log_type": "home"}',), ("{broken",), ('{"ts": "x"}',)], "value string")
    assert streams.parse_json(df, LOG_EVENT, "skip").count() == 1
    assert streams.parse_json(df, LOG_EVENT, "null").count() == 3
    with pytest.raises(Exception):
        streams.parse_json(df, LOG_EVENT, "fail").collect()


def test_kafka_options():
    o = streams.kafka_options("h:9092", "logs")
    assert o["startingOffsets"] == "earliest" and o["subscribe"] == "logs" and "kafka.group.id" not in o
    assert streams.kafka_options("h:9092", "logs", group_id="g")["kafka.group.id"] == "g"


def test_daily_window_aligns_to_local_midnight(spark):
    assert day_window_offset("Asia/Shanghai") == "960 minutes"
    t = dt.datetime(2025, 10, 22, 17, 0)  # 01:00 on the 23rd in Shanghai (UTC session)
    w = spark.createDataFrame([(t,)], "t timestamp").select(daily_window("t").alias("w")).first().w
    assert w.start == dt.datetime(2025, 10, 22, 16, 0) and w.end == dt.datetime(2025, 10, 23, 16, 0)


def test_layer_and_ods_writers_are_rerunnable(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "v int, dt date")
    path = sinks.write_layer(df, str(tmp_path), "dws", "t")
    sinks.write_layer(df.filter("v = 2").withColumn("v", F.lit(3)), str(tmp_path), "dws", "t")
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [(1, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 2))]
    sinks.write_ods(df, str(tmp_path / "ods"))
    assert spark.read.json(str(tmp_path / "ods")).count() == 2
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    with pytest.raises(ValueError):
        sinks.write_layer(df, str(tmp_path), "bad", "t")


def test_json_stream_sink(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"ts": 1700000000, "log_type": "home"}\n{bad\n')
    s = streams.read_log_stream(spark, {"format": "text", "path": str(src)})
    q = sinks.write_json_stream(s, {"path": str(tmp_path / "out")}, str(tmp_path / "ck"))
    q.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert len(rows) == 1 and rows[0].log_type == "home"


def test_jdbc_sync_round_trip(spark, tmp_path):
    """S5/S6 through an in-process Derby database (visible to this JVM only)."""
    url = "jdbc:derby:memory:emporia;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    for t in ("region", "nation"):
        src = spark.read.parquet(os.path.join(SMALL, f"{t}.parquet"))
        src = src.toDF(*[c.upper() for c in src.columns])  # unquoted identifiers in Derby
        src.write.format("jdbc").option("url", url).option("dbtable", t.upper()).options(**props).mode(
            "overwrite"
        ).save()
    paths = jdbc.sync_database(
        spark, url, str(tmp_path), catalog_query="SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'",
        properties=props,
    )
    assert set(paths) == {"REGION", "NATION"}
    got = spark.read.parquet(paths["NATION"])
    want = spark.read.parquet(os.path.join(SMALL, "nation.parquet"))
    assert got.rdd.getNumPartitions() > 1  # partitioned range reads
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_sales_stream_fixture_cases(spark, tmp_path):
    """Typed sales rows from JSON lines; a malformed line is
    dropped by the lenient reader only if nothing parses, a bad field is
    null with the other fields kept, and every ts form resolves."""
    import json

    src = tmp_path / "sales"
    src.mkdir()
    rows = [
        {"id": "1", "product_id": "p1", "total_amount": 10.5, "ts": "1761192000", "op": "r"},
        {"id": "2", "product_id": "p1", "total_amount": 1.25, "ts": "1761192000.123", "op": "+I"},
        {"id": "3", "product_id": "p2", "total_amount": 2, "ts": "1761192000123", "op": "+U"},
        {"id": "4", "product_id": "p2", "total_amount": 3, "ts": "", "insert_time": 1761192000999, "op": "-D"},
        {"id": "5", "product_id": "p3", "total_amount": "oops", "ts": "1761192001", "op": "r"},
    ]
    (src / "a.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n{not json\n")
    s = streams.read_sales_stream(spark, {"format": "text", "path": str(src)})
    q = s.writeStream.format("memory").queryName("sales_fixture").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r.id: r for r in spark.sql("SELECT * FROM sales_fixture").collect() if r.id}
    assert set(got) == {"1", "2", "3", "4", "5"}
    assert got["5"].total_amount is None and got["5"].product_id == "p3"
    wall = lambda r: r.event_time.replace(tzinfo=None)
    assert wall(got["1"]) == dt.datetime(2025, 10, 23, 4, 0)
    assert wall(got["2"]).microsecond == 123000 and wall(got["3"]).microsecond == 123000
    assert wall(got["4"]).microsecond == 999000


def test_dim_activity(spark):
    from emporia.plans.warehouse import dim_activity

    a = spark.createDataFrame([(1, "sale", dt.date(2024, 1, 1), dt.date(2024, 1, 7))],
                              "activity_id int, activity_name string, start_date date, end_date date")
    assert dim_activity(a).first().days == 7


def test_read_change_events_stream(spark, tmp_path):
    """Change-event envelopes from a file stream, a bad line dropped."""
    import json

    from emporia.plans.changes import flatten_change
    from emporia.plans.inputs import CHANGE_ROW

    src = tmp_path / "chg"
    src.mkdir()
    env = {"before": None, "after": {"user_id": 1, "event_type": "x", "value": 1.0}, "op": "c", "ts_ms": 5,
           "source": {"schema": "public", "table": "t", "lsn": 1}}
    (src / "a.json").write_text(json.dumps(env) + "\nnot json\n")
    s = flatten_change(streams.read_change_events(spark, {"format": "text", "path": str(src)}, CHANGE_ROW), CHANGE_ROW)
    q = s.writeStream.format("memory").queryName("chg_fixture").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.sql("SELECT * FROM chg_fixture").collect()
    assert [(r.user_id, r.op, r.ts_ms, r.source_table) for r in rows] == [(1, "c", 5, "t")]


def test_page_log_of_one_row_group_is_dealt_out(spark, tmp_path):
    """Events of a single file and row group are written as JSON in several tasks, each once."""
    rows = spark.range(1000).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' ts", "if(id % 7 = 0, null, id) user_id", "'view' event_type", "concat('{\"k\": ', id, '}') props"
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    lines = ods.ods_page_log(spark, str(tmp_path))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    try:
        parts = [r[0] for r in lines.select(F.spark_partition_id()).distinct().collect()]
        found = [r[0] for r in lines.selectExpr("cast(get_json_object(line, '$.sku_id') as long)").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert len(parts) > 1
    assert sorted(found) == list(range(1000))
