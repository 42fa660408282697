"""Streams that write a result once: final windows, arrival windows, timers, new users."""

import datetime as dt
import os

from pyspark.sql import functions as F

from emporia.plans import logs
from emporia.streaming import final, keyed, store

SALE = "event_time timestamp_ntz, id string, product_id string, total_amount double"


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def forget_last_commit(checkpoint):
    """As if the driver had been lost before the last batch was committed."""
    folder = f"{checkpoint}/commits"
    last = max(int(f) for f in os.listdir(folder) if f.isdigit())
    for f in (f"{folder}/{last}", f"{folder}/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)


def sale(at, user="u", amount=1.0):
    return (dt.datetime.fromisoformat(f"2024-01-{at}"), user, "p", amount)


def windows(spark, out):
    rows = final.read_gmv_final(spark, out).collect()
    ends = [(r.window_start, r.window_end) for r in rows]
    assert len(ends) == len(set(ends))
    return {r.window_end.isoformat(sep=" ")[5:16]: (float(r.gmv), r.top5_ids) for r in rows}


def test_windows_are_final_and_replayed_alike(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    run(final.start_gmv_final(land(spark, [sale("01 00:05:00"), sale("01 00:30:10", "v", 5.0)], SALE, src), out, cp))
    # The watermark is 00:30:05: three windows are closed, the fourth is not.
    first = windows(spark, out)
    assert first == {"01-01 00:10": (1.0, "u"), "01-01 00:20": (1.0, "u"), "01-01 00:30": (1.0, "u")}
    # Late for 00:10 to 00:30, but not for the windows still open; the next day closes them.
    run(final.start_gmv_final(land(spark, [sale("01 00:01:00", "late", 9.0), sale("02 00:00:10", "w", 2.0)], SALE, src), out, cp))
    second = windows(spark, out)
    assert {k: second[k] for k in first} == first
    assert second["01-01 00:40"] == (15.0, "late,v,u") and second["01-02 00:00"] == (15.0, "late,v,u") and len(second) == 144
    # A day whose windows are all closed takes nothing; the batch is run twice.
    run(final.start_gmv_final(land(spark, [sale("01 23:59:00", "lost", 99.0), sale("02 00:30:00")], SALE, src), out, cp))
    third = windows(spark, out)
    assert len(third) == 146 and third["01-02 00:20"] == (2.0, "w") and final.dropped_late(spark, out) == 1
    forget_last_commit(cp)
    run(final.start_gmv_final(spark.readStream.schema(SALE).parquet(src), out, cp))
    assert windows(spark, out) == third and final.dropped_late(spark, out) == 1


LOG = "arrived timestamp, event_id long, ts long, log_type string, user_id string"


def test_arrival_windows(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def row(i, at, ts, kind, user):
        return (dt.datetime.fromisoformat(f"2024-01-01 00:00:{at:02d}"), i, 1_704_067_200 + ts, kind, user)

    # By ts the first window of user a holds home, cart, pay; the pair over its edge is not counted.
    rows = [row(1, 1, 5, "cart", "a"), row(2, 2, 1, "home", "a"), row(3, 9, 7, "pay", "a"), row(4, 11, 8, "home", "a"), row(5, 12, 9, "home", "b"), row(6, 13, 10, None, "b"), row(7, 14, 11, "pay", "b"), row(8, 19, 12, "cart", "a"), row(9, 3, 13, "x", None)]
    run(final.start_arrival_paths(land(spark, rows, LOG, src), out, cp, seq="event_id"))
    end = [(dt.datetime.fromisoformat("2024-01-02 00:00:00"), 99, 0, None, "end")]
    run(final.start_arrival_paths(land(spark, end, LOG, src), out, cp, seq="event_id"))
    got = [(r.flush_end.second, r.path, r.cnt, r.total, r.line) for r in final.read_arrival_paths(spark, out).collect()]
    assert got == [
        (15, "cart→pay", 1, 1, "2024-01-01 (cart→pay,1)"),
        (15, "home→cart", 1, 1, "2024-01-01 (home→cart,1)"),
        (30, "home→cart", 1, 2, "2024-01-01 (home→cart,2)"),
    ]


WORDS = "ts long, log_type string, keywords array<string>"


def test_a_day_is_given_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def words(day, *ws):
        return [(1_704_067_200 + day * 86400, "search", [w]) for w in ws]

    def go(stream):
        q = keyed.start_keyword_once(stream, out, cp, 2, wait_s=0.5, trigger={"processingTime": "200 milliseconds"})
        keyed.stop_when_quiet(q, quiet_s=3.0, timeout_s=120)
        return [(r.log_date.day, r.rn, r.keyword, r.cnt) for r in keyed.read_keyword_once(spark, out, 2).collect()]

    first = go(land(spark, words(0, "a", "b", "b", "c", "c", "c"), WORDS, src))
    assert first == [(1, 1, "c", 3), (1, 2, "b", 2)]
    # After a restart, more rows of that day change nothing; the next day is given.
    assert go(land(spark, words(0, *["a"] * 9, "b") + words(1, "z"), WORDS, src)) == [*first, (2, 1, "z", 1)]


DEVICE_LOG = "ts long, event_id long, device struct<userkey:string,brand:string,plat:string,platv:string>"


def test_new_users_over_a_restart(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def row(i, day, user, brand="x"):
        return (1_704_067_200 + day * 86400 + i, i, (user, brand, "ios", None))

    lots = [[row(i, 0, f"u{i % 7}", None if i % 2 else "x") for i in range(40)], [row(50, 0, "u1", None), row(51, 0, "new"), row(52, 1, "u1"), row(53, 0, None)], [row(60, 0, "late", "x"), row(61, 5, "u1")]]
    for lot in lots:
        run(keyed.start_device_user_arrivals(land(spark, lot, DEVICE_LOG, src), out, cp, seq="event_id"))
    forget_last_commit(cp)
    run(keyed.start_device_user_arrivals(spark.readStream.schema(DEVICE_LOG).parquet(src), out, cp, seq="event_id"))
    got = keyed.read_device_user_arrivals(spark, out)
    want = logs.device_user_arrivals(spark.read.parquet(src), ("ts", "event_id"))
    want = want.withColumnRenamed("event_id", "seq").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_compaction_bounds_what_is_read(spark, tmp_path):
    """41 batches of two keys each, every one run twice; then the rows read are bounded by
    the keys and the batches since, not by all batches."""
    path = str(tmp_path / "store")
    sizes = []
    for e in range(41):
        for _ in range(2):
            store.append_latest(spark.createDataFrame([(e % 3, e), (100 + e % 5, e)], "k long, v long"), path, e, ["k"], every=8)
        sizes.append(spark.read.parquet(path).count())
    assert max(sizes) <= 8 + 2 * 8
    got = {r.k: r.v for r in store.latest(spark, path, ["k"]).collect()}
    assert got == {**{k: max(e for e in range(41) if e % 3 == k) for k in range(3)}, **{100 + k: max(e for e in range(41) if e % 5 == k) for k in range(5)}}


PATH_LOG = "ts long, event_id long, log_type string, user_id string"


def test_a_batch_reads_its_own_users_only(spark, tmp_path):
    """Each batch looks at the days of the users it brings; late rows correct the counts,
    and a batch that runs again changes nothing."""
    from pyspark.sql import Window

    from emporia.streaming import jobs

    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    kinds = ["home", "cart", "pay", None]

    def row(i, at, user):
        return (1_704_067_200 + at, i, kinds[(i * 7 + at) % 4], user)

    lots = [
        [row(i, (i * 37) % 90_000, f"u{i % 40}") for i in range(400)],
        [row(500 + i, (i * 41) % 90_000, "u3") for i in range(20)] + [row(600, 5, None)],
        [row(700, 50, "u3"), row(701, 86_401, "new")],
    ]
    for lot in lots:
        run(jobs.start_path_transitions(land(spark, lot, PATH_LOG, src), out, cp, seq="event_id", user_parts=32))
    forget_last_commit(cp)
    run(jobs.start_path_transitions(spark.readStream.schema(PATH_LOG).parquet(src), out, cp, seq="event_id", user_parts=32))
    got = {(r.log_date, r.path): r.cnt for r in jobs.read_path_transitions(spark, out).collect()}
    batch = logs.path_transitions(spark.read.parquet(src), order=("ts", "event_id"))
    assert got == {(r.log_date, r.path): r.cnt for r in batch.collect()}
    rows = spark.read.parquet(f"{out}/rows")
    own = rows.filter(F.col(store.EPOCH) == 2)
    looked_at = jobs.touched_rows(spark, out, own, 2)
    days = {r[0] for r in own.filter("user_id = 'u3'").select("log_date").distinct().collect()}
    assert looked_at.count() == rows.filter(F.col("user_id").isin("u3", "new") & F.col("log_date").isin(days)).count() + own.filter("user_id = 'new'").filter(~F.col("log_date").isin(days)).count()
    assert looked_at.count() < rows.count() / 5
    # Only the folders of their days and parts are scanned.
    plan = looked_at._jdf.queryExecution().executedPlan().toString()
    assert all("user_part" in scan.split("]", 1)[0] for scan in plan.split("PartitionFilters: [")[1:])


def test_keyed_deltas_give_the_latest_rows(spark, tmp_path):
    path = str(tmp_path / "keyed")
    state = {}
    for e in range(12):
        batch = [("a" if k % 2 else "b", k, e * 10 + k) for k in (e % 3, e % 5)]
        state |= {(d, k): v for d, k, v in batch}
        for _ in range(2):
            got = store.append_keyed(spark.createDataFrame(list(set(batch)), "day string, k long, v long"), path, "day", ["k"], e, every=4)
        days = {d for d, _, _ in batch}
        assert {(r.day, r.k): r.v for r in got.collect()} == {x: v for x, v in state.items() if x[0] in days}
    assert store.append_keyed(spark.createDataFrame([], "day string, k long, v long"), path, "day", ["k"], 12) is None


def test_append_keyed_runs_a_batch_once_into_few_files(spark, tmp_path):
    """400 rows of 40 tasks and two days: no row is computed twice, and a day has 8 files at most."""
    seen, path = spark.sparkContext.accumulator(0), f"{tmp_path}/rows"

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(400, numPartitions=40).selectExpr("if(id < 200, '2024-01-01', '2024-01-02') day", "id k", "id * 3 v")
    got = store.append_keyed(rows.mapInArrow(counted, rows.schema), path, "day", ["k"], 0)
    assert sorted(store.written(spark, path, "day", 0)) == ["2024-01-01", "2024-01-02"]
    assert sorted((str(r.day), r.k, r.v) for r in got.collect()) == [("2024-01-01" if k < 200 else "2024-01-02", k, k * 3) for k in range(400)]
    assert seen.value == 400
    assert len(spark.read.parquet(path).inputFiles()) <= 16


def test_page_view_windows_follow_local_midnight(spark):
    # 15:59:59 and 16:00:00 UTC are two days in Shanghai.
    rows = spark.createDataFrame([(1_704_124_799, "home"), (1_704_124_800, "home"), (1_704_124_800_000, None)], "ts long, log_type string")
    got = {(str(r.log_date), r.log_type): (r.pv, r.line) for r in logs.page_view_windows(rows).collect()}
    assert got == {
        ("2024-01-01", "home"): (1, "日期: 2024-01-01, 页面: home, PV: 1"),
        ("2024-01-02", "home"): (1, "日期: 2024-01-02, 页面: home, PV: 1"),
        ("2024-01-02", None): (1, "日期: 2024-01-02, 页面: null, PV: 1"),
    }


def test_sketches_and_bitmaps_merge_over_days(spark):
    from emporia.plans import warehouse as wh

    log = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("dt"), F.lit("view").alias("action"),
        F.pmod(F.col("id") * 7, F.lit(25_000)).alias("user_id"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("store_id"),
    )
    dims, span = ["store_id"], ("2024-01-02", "2024-01-08")
    want = {r.store_id: r.n for r in log.filter(F.col("dt").between(*span)).groupBy("store_id").agg(F.count_distinct("user_id").alias("n")).collect()}
    exact = {r.store_id: r.visitors for r in wh.visitors_exactly(wh.dws_visitor_bitmap_day(log, dims), dims, *span).collect()}
    about = {r.store_id: r.visitors for r in wh.visitors_about(wh.dws_visitor_sketch_day(log, dims), dims, *span).collect()}
    assert exact == want and set(about) == set(want)
    # Three times the standard error.
    assert all(abs(about[k] - n) <= 3 * 0.83 / 2 ** (wh.LG_K / 2) * n + 1 for k, n in want.items())
