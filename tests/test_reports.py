import datetime as dt
from decimal import Decimal

from emporia.functions.text import MISSING
from emporia.plans import reports
from emporia.schemas import PRODUCT_DETAIL, REPORT_WINDOW_GMV


def _report(spark, rows):
    out = []
    for day, end_h, gmv, ids in rows:
        d = dt.date(2025, 10, day)
        start = dt.datetime.combine(d, dt.time())
        out.append((d, start, start + dt.timedelta(hours=end_h), Decimal(gmv), ids))
    return spark.createDataFrame(out, REPORT_WINDOW_GMV)


def test_repeat_rate_rules(spark):
    rep = _report(
        spark,
        [
            (20, 1, "50.00", "9,9"),
            (20, 5, "100.00", "1,2,3"),  # latest of the 20th wins
            (21, 3, "110.00", f"{MISSING},2,3,4"),
            (22, 3, "0.00", "7"),
            (23, 3, "10.00", "8"),  # no overlap with the 22nd, previous GMV 0
            (24, 3, "5.00", MISSING),  # sentinel alone: the day vanishes
        ],
    )
    dim = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "three")], PRODUCT_DETAIL)
    got = {r.ds.day: r for r in reports.repeat_rate(rep, dim, with_prev_descs=True).collect()}
    assert sorted(got) == [20, 21, 22, 23]
    assert got[20].mon_rate is None and got[20].repeat_rate is None
    assert got[21].mon_rate == "10.00%" and got[21].repeat_rate == "40.00%"
    assert got[21].top5_product_ids == "2,3,4" and got[21].last_day_product_ids == "1,2,3"
    assert got[21].top5_product_descs == "two,three" and got[21].last_day_product_descs == "one,two,three"
    assert got[23].mon_rate is None and got[23].repeat_rate is None


def test_sentinel_days_overlap_by_default(spark):
    rep = _report(spark, [(20, 1, "1.00", f"{MISSING},1"), (21, 1, "2.00", f"{MISSING},2")])
    dim = spark.createDataFrame([], PRODUCT_DETAIL)
    got = {r.ds.day: r.repeat_rate for r in reports.repeat_rate(rep, dim).collect()}
    assert got[21] == "20.00%"
    got = {r.ds.day: r.repeat_rate for r in reports.repeat_rate(rep, dim, drop_missing_in_overlap=True).collect()}
    assert got[21] is None


def test_product_dimension_fan_out(spark):
    rep = _report(spark, [(20, 1, "1.00", "1,5")])
    dim = spark.createDataFrame([("1", "a"), ("1", "b")], PRODUCT_DETAIL)
    rows = reports.top_products(rep, dim).collect()
    assert sorted((r.exploded_product_id, r.product_desc) for r in rows) == [("1", "a"), ("1", "b"), ("5", None)]
