import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators import (
    explode_keywords,
    explode_split,
    ip_region_join,
    latest_by,
    top_n,
    transitions,
)
from emporia.plans.gmv import gmv_topn_report


def _sales(spark, rows):
    return spark.createDataFrame(rows, "event_time timestamp_ntz, total_amount double, id string, product_id string")


def test_boundary_event_belongs_to_next_window(spark):
    t = dt.datetime(2025, 10, 23, 0, 10, 0)  # exactly on a 10-minute boundary
    out = gmv_topn_report(_sales(spark, [(t, 5.0, "a", "p")])).orderBy("window_end").collect()
    assert out[0].window_end == dt.datetime(2025, 10, 23, 0, 20)
    assert len(out) == 144 - 1  # windows ending 00:20 .. 24:00
    assert out[-1].window_end == dt.datetime(2025, 10, 24, 0, 0)


def test_quiet_panes_repeat_and_totals(spark):
    d = dt.datetime(2025, 10, 23)
    rows = [
        (d + dt.timedelta(minutes=1), 10.0, "a", "p1"),
        (d + dt.timedelta(minutes=55), 20.0, "b", "p2"),
        (d + dt.timedelta(hours=23, minutes=59), 1.0, "a", "p1"),
    ]
    out = gmv_topn_report(_sales(spark, rows)).orderBy("window_end").collect()
    assert len(out) == 144
    gmv = [float(r.gmv) for r in out]
    assert gmv == sorted(gmv)  # cumulative GMV never decreases
    assert gmv[-1] == 31.0  # the day's last window is the day total
    assert out[0].top5_ids == "a" and out[5].top5_ids == "b,a"
    assert out[-1].top5_product_ids == "p2,p1"


def test_top5_ties_break_on_id_and_cap(spark):
    d = dt.datetime(2025, 10, 23, 1)
    rows = [(d, 5.0, f"u{i}", "p") for i in range(7)]
    last = gmv_topn_report(_sales(spark, rows)).orderBy(F.desc("window_end")).first()
    assert last.top5_ids == "u0,u1,u2,u3,u4"


def test_top_n_and_latest_by(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, "w")], "k string, v int, s string")
    got = sorted(tuple(r) for r in top_n(df, ["k"], [F.desc("v"), F.asc("s")], 1).select("k", "s").collect())
    assert got == [("a", "y"), ("b", "w")]
    got = sorted(tuple(r) for r in latest_by(df, ["k"], ["v"]).collect())
    assert got == [("a", 3, "z"), ("b", 2, "w")]


def test_transitions_equal_lag_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        user = "hot" if i % 3 == 0 else f"u{rnd.randint(0, 40)}"
        t = rnd.randint(0, 5 * 3_600_000)
        typ = rnd.choice(["a", "b", "c", None])
        rows.append((i, user, t, typ))
    df = spark.createDataFrame(rows, "eid long, user string, ts long, typ string")
    got = transitions(df, "user", ["ts", "eid"], "typ", F.floor(F.col("ts") / 600_000), "prev")
    w = Window.partitionBy("user").orderBy("ts", "eid")
    want = df.withColumn("prev", F.lag("typ").over(w))
    assert sorted(map(tuple, got.select("eid", "prev").collect()), key=str) == sorted(
        map(tuple, want.select("eid", "prev").collect()), key=str
    )


def test_ip_region_join_matches_brute_force(spark):
    rnd = random.Random(3)
    ranges = []
    lo = 0
    for i in range(40):
        lo += rnd.randint(1, 3_000_000)
        hi = lo + rnd.randint(0, 2_000_000)
        ranges.append((lo, hi, f"r{i}"))
        lo = hi + 1
    r = spark.createDataFrame(ranges, "start_ip long, end_ip long, region string")
    ips = [(i, rnd.randint(0, lo + 1000)) for i in range(500)] + [(999, None)]
    df = spark.createDataFrame(ips, "id int, ip long")
    got = dict(ip_region_join(df, "ip", r).select("id", "region").collect())

    def find(ip):
        for a, b, name in ranges:
            if ip is not None and a <= ip <= b:
                return name
        return None

    assert got == {i: find(ip) for i, ip in ips}


def test_generators(spark):
    df = spark.createDataFrame([(["  x ", "", "y"],), ([],), (None,)], "keywords array<string>")
    assert [r.keyword for r in explode_keywords(df).collect()] == ["x", "y"]
    df = spark.createDataFrame([("a,b",), ("",), (None,)], "s string")
    got = [(r.pos, r.item) for r in explode_split(df, "s").collect()]
    assert got == [(0, "a"), (1, "b"), (0, "")]


def test_overlapping_ip_ranges_take_the_narrowest(spark):
    ranges = spark.createDataFrame([(0, 200_000, "wide"), (100, 300, "narrow"), (70_000, 70_001, "tiny")], "start_ip long, end_ip long, region string")
    rows = spark.createDataFrame([(1, 150), (2, 99), (3, 70_000), (4, 999_999), (5, None)], "i int, ip long")
    got = {r.i: r.region for r in ip_region_join(rows, "ip", ranges).collect()}
    assert got == {1: "narrow", 2: "wide", 3: "tiny", 4: None, 5: None}


def test_null_keys_meet_in_outer_joins(spark):
    from emporia.operators.joins import null_safe_on

    a = spark.createDataFrame([(1, None, 5), (1, 2, 6)], "d int, k int, x int")
    b = spark.createDataFrame([(1, None, 7), (2, 3, 8)], "d int, k int, y int")
    got = sorted(null_safe_on(a, b, ["d", "k"], "full_outer").collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(1, None, 5, 7), (1, 2, 6, None), (2, 3, None, 8)], key=str)


def test_ipv4_to_long_rejects_malformed(spark):
    from emporia.operators.joins import ipv4_to_long

    rows = [("1.0.0.5",), ("255.255.255.255",), ("1.2.3",), ("256.1.1.1",), ("a.b.c.d",), ("",), (None,), ("1.2.3.4.5",)]
    got = [r[0] for r in spark.createDataFrame(rows, "ip string").select(ipv4_to_long("ip")).collect()]
    assert got == [16777221, 4294967295, None, None, None, None, None, None]
