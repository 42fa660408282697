"""Range lookups by the interval index against brute force."""

import ipaddress
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.operators import intervals
from emporia.operators.joins import ip_binary, ip_region_join

RANGE = "start_ip long, end_ip long, region string"


def best(ranges, value):
    return min(((e - s, s, r) for s, e, r in ranges if s <= value <= e), default=(0, 0, None))[2]


@pytest.mark.parametrize(("count", "top"), [(30, 1000), (700, 1 << 32), (1500, 1 << 20)])
def test_overlapping_ranges(spark, count, top):
    rng = random.Random(count)
    ranges = [(0, top, "all"), (5, 5, "five"), (5, 5, "also five")]
    for i in range(count):
        s = rng.randrange(top)
        ranges.append((s, min(top, s + rng.choice([0, 1, 10, top // 100, top // 3])), f"r{i % 50}"))
    values = [rng.randrange(top + 5) for _ in range(500)] + [x for s, e, _ in ranges[:150] for x in (s, e)]
    rows = spark.createDataFrame([*enumerate(values), (-1, None)], "i long, ip long")
    got = dict(ip_region_join(rows, "ip", spark.createDataFrame(ranges, RANGE)).select("i", "region").collect())
    assert got == {-1: None, **{i: best(ranges, v) for i, v in enumerate(values)}}


def test_odd_ranges(spark):
    ranges = spark.createDataFrame([(10, 5, "backwards"), (None, 3, "open"), (7, 9, None)], RANGE)
    rows = spark.createDataFrame([(1, 7), (2, 6), (3, 1)], "i long, ip long")
    assert {r.i: r.region for r in ip_region_join(rows, "ip", ranges).collect()} == {1: None, 2: None, 3: None}
    assert ip_region_join(rows, "ip", ranges.limit(0)).filter("region is not null").isEmpty()


def test_half_a_million_overlapping_ranges(spark, tmp_path):
    n = 500_000
    path = str(tmp_path / "ranges")
    start = F.pmod(F.col("id") * 2654435761, F.lit(1 << 32))
    end = F.least(start + F.expr("shiftleft(1L, int((id * 31) % 32))") - 1, F.lit((1 << 32) - 1))
    spark.range(n).select(start.alias("start_ip"), end.alias("end_ip"), F.concat(F.lit("r"), F.col("id") % 1000).alias("region")).write.parquet(path)
    ranges = spark.read.parquet(path)
    index = intervals.build_index(ranges, "start_ip", "end_ip", "region", F.col("end_ip") - F.col("start_ip"))
    # Wide ranges are not copied into all slots: there are not many more pieces than bounds.
    assert index.pieces.select(F.sum(F.size("starts"))).first()[0] <= 2 * n + len(index.edges) + 1
    ids = np.arange(n)
    s = ids * 2654435761 % (1 << 32)
    e = np.minimum(s + (1 << (ids * 31 % 32)) - 1, (1 << 32) - 1)
    values = np.random.default_rng(1).integers(0, 1 << 32, 150).tolist()
    rows = spark.createDataFrame(list(enumerate(values)), "i long, ip long")
    got = dict(intervals.lookup(rows, "ip", index, "region").select("i", "region").collect())
    for i, v in enumerate(values):
        hits = np.flatnonzero((s <= v) & (v <= e))
        assert got[i] == min(((e[j] - s[j], s[j], f"r{j % 1000}") for j in hits), default=(0, 0, None))[2]


def test_ipv6_text(spark):
    texts = ["::", "::1", "1.2.3.4", "2001:db8::ff00:42:8329", "2001:DB8:0:0:0:ff00:42:8329", "::ffff:1.2.3.4", "1:2:3:4:5:6:7:8", "1::8", "1:2:3:4:5:6:7::",
             "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "1:2:3", ":::", "12345::", "1.2.3", "1:2:3:4:5:6:7:8:9", "", "g::", "1::2::3"]
    for r in spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", ip_binary("t").alias("b")).collect():
        try:
            a = ipaddress.ip_address(r.t)
            want = bytes(10) + b"\xff\xff" + a.packed if a.version == 4 else a.packed
        except ValueError:
            want = None
        assert (None if r.b is None else bytes(r.b)) == want, r.t


def test_ipv6_ranges(spark):
    rng = random.Random(4)
    ranges = []
    for i in range(600):
        s = rng.randrange(1 << 128)
        ranges.append((s, min((1 << 128) - 1, s + rng.randrange(1 << rng.choice([3, 64, 65, 120, 127]))), f"r{i}"))
    values = [rng.choice([rng.randrange(1 << 128), ranges[rng.randrange(600)][rng.randrange(2)]]) for _ in range(300)]
    raw = spark.createDataFrame([(s.to_bytes(16, "big"), e.to_bytes(16, "big"), r) for s, e, r in ranges], "start_ip binary, end_ip binary, region string")
    rows = spark.createDataFrame([(i, v.to_bytes(16, "big")) for i, v in enumerate(values)], "i long, ip binary")
    got = dict(ip_region_join(rows, "ip", raw).select("i", "region").collect())
    assert got == {i: best(ranges, v) for i, v in enumerate(values)}
