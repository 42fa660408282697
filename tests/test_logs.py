import datetime as dt

from emporia.functions.text import UNKNOWN
from emporia.plans import logs
from emporia.schemas import IP_RANGES, LOG_EVENT

D = dt.datetime(2025, 10, 23, 2, 0, tzinfo=dt.timezone.utc)  # 10:00 in Shanghai
S = int(D.timestamp())


def _logs(spark, rows):
    return spark.createDataFrame(rows, LOG_EVENT)


def row(ts, typ="home", user="u1", kws=None, ip=None, device=None):
    return (ts, typ, user, kws, None if ip is None else (ip,), device)


def test_page_views_drop_null_ts_and_mix_units(spark):
    df = _logs(spark, [row(S), row(S * 1000 + 5), row(None), row(S, None)])
    got = {(r.log_type, r.pv) for r in logs.page_views(df).collect()}
    assert got == {("home", 2), (None, 1)}


def test_keyword_counts_are_true_counts(spark):
    rows = [row(S, "search", kws=[" shoe ", "", "bag"]), row(S, "search", kws=["shoe"]), row(S, "search", kws=None),
            row(S, "home", kws=["shoe"])]
    got = [(r.rn, r.keyword, r.cnt) for r in logs.keyword_top_n(_logs(spark, rows), 10).orderBy("rn").collect()]
    assert got == [(1, "shoe", 2), (2, "bag", 1)]


def test_login_regions_rules(spark):
    ranges = spark.createDataFrame(
        [(16777216, 16777471, "中国|0|广东省深圳市|x"), (16777472, 16777727, "美国|0|0|x")], IP_RANGES
    )
    rows = [
        row(S, "login", ip="1.0.0.5"),
        row(S, "login", ip="1.0.1.9"),
        row(S, "login", ip="9.9.9.9"),
        row(S, "login", ip=""),
        row(S, "login"),
        row(S, "home", ip="1.0.0.5"),
    ]
    got = {(r.full_region, r.logins) for r in logs.login_regions(_logs(spark, rows), ranges).collect()}
    assert got == {("广东省深圳市", 1), (UNKNOWN, 2)}


def test_path_transitions_rules(spark):
    rows = [
        row(S + 3, "cart"),
        row(S + 1, "home"),
        row(S + 2, "home"),
        row(S + 4, None),
        row(S + 5, "pay"),
        row(S + 6, "home", user="u2"),
    ]
    got = {(r.path, r.cnt) for r in logs.path_transitions(_logs(spark, rows)).collect()}
    assert got == {("home→cart", 1)}


def test_device_users_rules(spark):
    dev = lambda k, b, p, v: (k, b, p, v)
    rows = [
        row(S, device=dev("k1", "apple", "ios", "17")),
        row(S, device=dev("k1", "apple", "ios", "17")),
        row(S, device=dev("k2", "apple", "ios", "17")),
        row(S, device=dev("k3", None, "ios", None)),
        row(S, device=dev(None, "x", "ios", "1")),
        row(S, device=dev("k4", "x", None, "1")),
    ]
    got = {(r.brand, r.platv, r.users) for r in logs.device_users(_logs(spark, rows)).collect()}
    assert got == {("apple", "17", 2), (None, None, 1)}


def test_path_transitions_event_time_slices(spark):
    base = (S // 10) * 10  # start of a 10 s slice
    rows = [row(base + 1, "home"), row(base + 2, "cart"), row(base + 11, "pay"), row(base + 12, "home")]
    whole = {(r.path, r.cnt) for r in logs.path_transitions(_logs(spark, rows)).collect()}
    assert whole == {("home→cart", 1), ("cart→pay", 1), ("pay→home", 1)}
    sliced = {(r.path, r.cnt) for r in logs.path_transitions(_logs(spark, rows), slice_ms=10_000).collect()}
    assert sliced == {("home→cart", 1), ("pay→home", 1)}


def test_device_users_approximate_option(spark):
    rows = [row(S, device=(f"k{i}", "apple", "ios", "17")) for i in range(200)]
    exact = logs.device_users(_logs(spark, rows)).first().users
    approx = logs.device_users(_logs(spark, rows), approx_rsd=0.02).first().users
    assert exact == 200 and abs(approx - 200) <= 20
