import datetime as dt

from pyspark.sql import functions as F

from emporia.functions.text import UNKNOWN, absolute_url, growth_rate, percent_text, region_parts
from emporia.functions.time import epoch_ms, event_time, local_date, local_time_str, wall_clock


def test_epoch_ms_seconds_and_millis(spark):
    df = spark.createDataFrame([(1761192000,), (1761192000123,), (None,)], "ts long")
    got = [r[0] for r in df.select(epoch_ms("ts")).collect()]
    assert got == [1761192000000, 1761192000123, None]


def test_event_time_cases(spark):
    rows = [
        ("1761192000", 5),
        ("1761192000.123", 5),
        ("1761192000123", 5),
        ("", 1761192000999),
        (None, 1761192000999),
        ("abc", 5),
    ]
    df = spark.createDataFrame(rows, "ts string, insert_time long")
    got = [r[0] for r in df.select(wall_clock(event_time("ts", "insert_time"), "UTC")).collect()]
    base = dt.datetime(2025, 10, 23, 4, 0, 0)
    assert got[0] == base
    assert got[1] == base + dt.timedelta(milliseconds=123)
    assert got[2] == base + dt.timedelta(milliseconds=123)
    assert got[3] == got[4] == base + dt.timedelta(milliseconds=999)
    assert got[5] is None


def test_local_date_and_time_shanghai(spark):
    # 2025-10-22 16:30 UTC is 2025-10-23 00:30 in Shanghai.
    ms = int(dt.datetime(2025, 10, 22, 16, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(ms,)], "ms long")
    d, s = df.select(local_date("ms"), local_time_str("ms")).first()
    assert d == dt.date(2025, 10, 23) and s == "2025-10-23 00:30:00"


def test_region_parts_fixture_table(spark):
    cases = [
        ("中国|0|广东省|深圳市|电信", "广东省", "广东省", "广东省"),
        ("中国|0|广东省深圳市|x", "广东省", "深圳市", "广东省深圳市"),
        ("中国|0|内蒙古自治区|x", "内蒙古自治区", "内蒙古自治区", "内蒙古自治区"),
        ("中国|0|北京市|x", "北京市", "北京市", "北京市"),
        ("美国|0|0|x", UNKNOWN, UNKNOWN, UNKNOWN),
        (None, UNKNOWN, UNKNOWN, UNKNOWN),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "region string")
    p, c, f = region_parts("region")
    got = [tuple(r) for r in df.select(p, c, f).collect()]
    assert got == [c[1:] for c in cases]


def test_absolute_url(spark):
    df = spark.createDataFrame([(" /a/b ",), ("info/1.htm",), ("https://x.org/y",)], "h string")
    got = [r[0] for r in df.select(absolute_url("h", "https://site.example/")).collect()]
    assert got == ["https://site.example/a/b", "https://site.example/info/1.htm", "https://x.org/y"]


def test_growth_and_percent(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None)], "cur double, prev double")
    got = [r[0] for r in df.select(percent_text(growth_rate("cur", "prev"))).collect()]
    assert got == ["10.00%", None, None]
    one = spark.range(1).select(percent_text(F.lit(2) / F.lit(5.0) * 100)).first()[0]
    assert one == "40.00%"
