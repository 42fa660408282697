"""Stream = batch: the events split into time-ordered files, one file per
micro-batch, must give the batch result (state carried across batches)."""

import os
import time

import pytest
from pyspark.sql import functions as F

from emporia.plans import changes, gmv, inputs, logs
from emporia.plans.catalog import CHANGE_ROW
from emporia.streaming import jobs, store

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split_events(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("events"))
    ev = inputs.events(spark, SMALL)
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    # Contiguous day ranges so every file is later than the one before.
    per = (len(days) + 3) // 4
    for i in range(4):
        part = days[i * per:(i + 1) * per]
        if part:
            ev.filter(F.to_date("ts").isin(part)).coalesce(1).write.parquet(f"{d}/part{i}")
    return d


def _stream(spark, d):
    schema = inputs.events(spark, SMALL).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/*/*.parquet")


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch(spark, split_events, tmp_path):
    src = _stream(spark, split_events)
    log_s = inputs.log_rows(src)
    log_b = inputs.log_events(spark, SMALL)

    out, ck = str(tmp_path / "pv"), str(tmp_path / "pv_ck")
    q = jobs.start_page_views(log_s, out, ck)
    q.awaitTermination()
    assert len(os.listdir(out)) > 2  # several micro-batches ran
    _same(store.latest(spark, out, ["log_date", "log_type"]), logs.page_views(log_b))

    out, ck = str(tmp_path / "kw"), str(tmp_path / "kw_ck")
    jobs.start_keyword_top_n(log_s, out, ck, 10, "click").awaitTermination()
    _same(spark.read.parquet(f"{out}/top").select("log_date", "rn", "keyword", "cnt"),
          logs.keyword_top_n(log_b, 10, "click"))

    out, ck = str(tmp_path / "path"), str(tmp_path / "path_ck")
    jobs.start_path_transitions(log_s, out, ck, seq="event_id").awaitTermination()
    _same(jobs.read_path_transitions(spark, out),
          logs.path_transitions(log_b, order=("ts", "event_id")))

    out, ck = str(tmp_path / "dev"), str(tmp_path / "dev_ck")
    jobs.start_device_users(log_s, out, ck).awaitTermination()
    _same(store.latest(spark, out, ["dt", "plat", "brand", "platv"]), logs.device_users(log_b))

    out, ck = str(tmp_path / "gmv"), str(tmp_path / "gmv_ck")
    jobs.start_gmv_report(inputs.sales_rows(src), out, ck).awaitTermination()
    want = gmv.gmv_topn_report(inputs.sales_events(spark, SMALL))
    _same(jobs.read_gmv_report(spark, out), want)

    env = changes.parse_changes(inputs.change_rows(src), CHANGE_ROW)
    flat = changes.flatten_change(env, CHANGE_ROW)
    out, ck = str(tmp_path / "cs"), str(tmp_path / "cs_ck")
    jobs.start_current_state(flat, out, ck, ["user_id"]).awaitTermination()
    batch_flat = changes.flatten_change(changes.parse_changes(inputs.change_log(spark, SMALL), CHANGE_ROW), CHANGE_ROW)
    _same(jobs.read_current_state(spark, out, ["user_id"]), changes.current_state(batch_flat, ["user_id"]))


def test_snapshot_merge_is_replay_safe(spark, tmp_path):
    path = str(tmp_path / "snap")
    schema = "day string, k string, v long"
    b0 = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 1), ("d2", "a", 5)], schema)
    b1 = spark.createDataFrame([("d1", "a", 3), ("d1", "c", 1)], schema)
    store.merge_snapshot(b0, path, "day", ["k"], 0)
    first = sorted(map(tuple, store.merge_snapshot(b1, path, "day", ["k"], 1).select("day", "k", "v").collect()))
    again = sorted(map(tuple, store.merge_snapshot(b1, path, "day", ["k"], 1).select("day", "k", "v").collect()))
    assert first == again == [("d1", "a", 3), ("d1", "b", 1), ("d1", "c", 1)]
    final = sorted(map(tuple, store.latest_snapshots(spark, path, "day").select("day", "k", "v").collect()))
    assert final == [("d1", "a", 3), ("d1", "b", 1), ("d1", "c", 1), ("d2", "a", 5)]
    store.merge_snapshot(b1, path, "day", ["k"], 2)
    assert store.drop_superseded(spark, path, "day") == 1
    assert sorted(map(tuple, store.latest_snapshots(spark, path, "day").select("day", "k", "v").collect())) == final


@pytest.fixture(scope="module")
def newest_first(spark, tmp_path_factory):
    """Four files of contiguous days; the file source takes the newest days first."""
    d = str(tmp_path_factory.mktemp("newest"))
    ev = inputs.events(spark, SMALL)
    days = sorted((r[0] for r in ev.select(F.to_date("ts")).distinct().collect()), reverse=True)
    per = (len(days) + 3) // 4
    for i in range(4):
        ev.filter(F.to_date("ts").isin(days[i * per:(i + 1) * per])).coalesce(1).write.parquet(f"{d}/part{i}")
        time.sleep(1.1)  # the source orders files by their modification time
    return d


def test_nothing_is_lost_when_the_newest_days_come_first(spark, newest_first, tmp_path):
    src = _stream(spark, newest_first)
    log_s, log_b = inputs.log_rows(src), inputs.log_events(spark, SMALL)

    def run(start, *args, **kw):
        out = str(tmp_path / start.__name__)
        q = start(*args[:1], *kw.pop("extra", ()), out, out + "_ck", **kw)
        q.awaitTermination()
        assert jobs.dropped_rows(q) == 0
        return out

    _same(store.latest(spark, run(jobs.start_page_views, log_s), ["log_date", "log_type"]), logs.page_views(log_b))
    out = run(jobs.start_keyword_top_n, log_s, n=10, search_type="click")
    top = jobs.read_keyword_top_n(spark, out)
    _same(top, logs.keyword_top_n(log_b, 10, "click"))
    order = [(r.log_date, r.rn) for r in top.collect()]
    assert order == sorted(order)
    ranges = inputs.ip_ranges(spark, SMALL)
    out = run(jobs.start_login_regions, log_s, extra=(ranges,), login_type="signup")
    _same(store.latest(spark, out, ["log_date", "full_region"]), logs.login_regions(log_b, ranges, "signup"))
    _same(store.latest(spark, run(jobs.start_device_users, log_s), ["dt", "plat", "brand", "platv"]), logs.device_users(log_b))
    _same(jobs.read_path_transitions(spark, run(jobs.start_path_transitions, log_s, seq="event_id")),
          logs.path_transitions(log_b, order=("ts", "event_id")))
    out = run(jobs.start_gmv_report, inputs.sales_rows(src), n=7)
    _same(jobs.read_gmv_report(spark, out, 7), gmv.gmv_topn_report(inputs.sales_events(spark, SMALL), n=7))


def test_dropped_rows_are_told(spark, newest_first, tmp_path):
    out = str(tmp_path / "pv")
    q = jobs.start_page_views(inputs.log_rows(_stream(spark, newest_first)), out, out + "_ck", lateness="1 day")
    q.awaitTermination()
    assert jobs.dropped_rows(q) > 0
    with pytest.raises(RuntimeError):
        jobs.fail_on_drops(q)


def test_unreadable_snapshot_folder_fails_the_batch(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = spark.createDataFrame([("d1", "a", 1)], "day string, k string, v long")
    store.merge_snapshot(rows, path, "day", ["k"], 0)
    part = os.path.join(path, "day=d1", "_epoch=0")
    for f in os.listdir(part):
        if f.endswith(".parquet"):
            with open(os.path.join(part, f), "wb") as h:
                h.write(b"broken")
    with pytest.raises(Exception):
        store.merge_snapshot(rows, path, "day", ["k"], 1)
