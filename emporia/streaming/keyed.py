"""Stream jobs with keyed state and timers.

State lives in Spark's state store (``transformWithState``: list, value and map state,
timers), which checkpoints and restores it; the processors only say what a key does.  A
key is never a whole day: days are split into ``BUCKETS`` by a hash of the keyword or
user, so a large day is spread over all tasks.
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from emporia.functions.time import DEFAULT_TZ
from emporia.operators.generators import explode_keywords
from emporia.operators.ranking import top_n
from emporia.operators.running import running_sum
from emporia.plans import logs
from emporia.streaming import store
from emporia.streaming.jobs import _start

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 64
SHUFFLE = "spark.sql.shuffle.partitions"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """A query started inside keeps its state in RocksDB, as keyed state needs, in at most two
    partitions a core: each is a task with a Python worker in every batch.  A query takes
    its settings when it starts, and a checkpoint keeps the number of partitions."""
    parts = min(int(spark.conf.get(SHUFFLE)), 2 * spark.sparkContext.defaultParallelism)
    old = {k: spark.conf.get(k, None) for k in (PROVIDER, SHUFFLE)}
    spark.conf.set(PROVIDER, ROCKSDB)
    spark.conf.set(SHUFFLE, str(parts))
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# ---- T10/T11: list state, a timer, once a day -------------------------------------


class TopOnce(StatefulProcessor):
    """Counts of a (day, bucket) in list state; the timer that its first rows set gives the
    ``n`` most frequent, once, and empties the list.  Rows after that are ignored."""

    def __init__(self, n: int, wait_ms: int):
        self.n, self.wait_ms = n, wait_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getListState("counts", "keyword string, cnt long")
        self.given = handle.getValueState("given", "given boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.given.exists():
            return
        if not self.counts.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        # One entry a keyword and batch.
        for keyword, cnt in Counter(r.keyword for r in rows).items():
            self.counts.appendValue((keyword, cnt))
        return
        yield

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.given.exists():
            return
        total: Counter[str] = Counter()
        for keyword, cnt in self.counts.get():
            total[keyword] += cnt
        self.given.update((True,))
        self.counts.clear()
        for keyword, cnt in sorted(total.items(), key=lambda x: (-x[1], x[0].encode()))[: self.n]:
            yield Row(log_date=key[0], keyword=keyword, cnt=cnt)

    def close(self) -> None:
        pass


def start_keyword_once(
    log_stream: DataFrame, out: str, checkpoint: str, n: int = 10, search_type: str = "search", tz: str = DEFAULT_TZ, wait_s: float = 2.0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """M2 with the source's timer: ``wait_s`` after the first keywords of a day came (by the
    clock of the cluster), the day's Top-``n`` is given, and never again.

    Every bucket of a day gives its own first ``n``, so the day's are among them;
    ``read_keyword_once`` ranks them.  Timers keep a query running: use a processing-time
    trigger, and end it with ``stop_when_quiet``.
    """
    rows = logs.normalise(log_stream.filter(F.col("log_type") == search_type), tz)
    words = explode_keywords(rows.select("log_date", "keywords")).withColumn("bucket", F.pmod(F.xxhash64("keyword"), F.lit(BUCKETS)))
    with keyed_state(log_stream.sparkSession):
        tops = words.groupBy("log_date", "bucket").transformWithState(TopOnce(n, int(wait_s * 1000)), "log_date date, keyword string, cnt long", "Append", "ProcessingTime")
        return _start(tops, lambda b, e: store.append_epoch(b, out, e), checkpoint, "append", trigger or {"processingTime": "1 second"}, None)


def read_keyword_once(spark: SparkSession, out: str, n: int = 10) -> DataFrame:
    """The days that were given, sorted, with their Top-``n``."""
    rows = spark.read.parquet(out).drop(store.EPOCH)
    best = top_n(rows, ["log_date"], [F.desc("cnt"), F.asc("keyword")], n, "rn")
    return best.select("log_date", F.col("rn").cast("int").alias("rn"), "keyword", "cnt").orderBy("log_date", "rn")


def stop_when_quiet(query: StreamingQuery, quiet_s: float, timeout_s: float = 600.0) -> None:
    """Stop ``query`` once a batch that began ``quiet_s`` (longer than its timers) after the
    input ran dry has finished."""
    deadline, dry = time.monotonic() + timeout_s, None
    while time.monotonic() < deadline:
        if query.exception():
            raise query.exception()
        p = query.lastProgress
        if p and p["numInputRows"] == 0:
            began = dt.datetime.fromisoformat(p["timestamp"]).timestamp()
            dry = dry or began
            if began - dry > quiet_s:
                query.stop()
                return
        else:
            dry = None
        time.sleep(0.2)
    query.stop()
    raise TimeoutError("stream did not go quiet in time")


# ---- T13/A5: map state, output at each new user -----------------------------------


class FirstSightings(StatefulProcessor):
    """Users of a (day, device, bucket) in map state; each is given once, at its first row.
    A timer at the day's end by the watermark empties the map."""

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("users", "userkey string", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first: dict[str, tuple] = {}
        end = None
        for r in rows:
            place = (r.ts, r.seq)
            if r.userkey not in first or place < first[r.userkey]:
                first[r.userkey] = place
            end = r.day_end
        if end is not None:
            self.handle.registerTimer(int(end.timestamp() * 1000))
        for userkey, (ts, seq) in first.items():
            if not self.seen.containsKey((userkey,)):
                self.seen.updateValue((userkey,), (True,))
                yield Row(dt=key[0], plat=key[1], brand=key[2], platv=key[3], userkey=userkey, ts=ts, seq=seq)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return
        yield

    def close(self) -> None:
        pass


SIGHTING = "dt date, plat string, brand string, platv string, userkey string, ts long, seq long"


def start_device_user_arrivals(
    log_stream: DataFrame, out: str, checkpoint: str, tz: str = DEFAULT_TZ, seq: str | None = None, lateness: str = "2 days", trigger: dict | None = None
) -> StreamingQuery:
    """M5 as the source emits it: a row per new user of a (dt, plat, brand, platv), with the
    users it has had by then, in the order of (ts, seq) within a batch and of batches.

    Users seen are kept per day until the watermark, ``lateness`` behind the newest day's
    end, has passed the day's end; a row of an open day is never dropped, so ``lateness`` is
    how long a day stays open behind the newest.  A batch numbers its new users
    (``running_sum``, so a large device is no single task) behind the count that the batch
    before stored for the device.
    """
    tz_end = F.to_timestamp(F.date_add("dt", 1))
    rows = logs.device_rows(log_stream, "ts", *([seq] if seq else []), tz=tz)
    rows = rows.withColumn("seq", (F.col(seq) if seq else F.lit(0)).cast("long")).withColumn("day_end", tz_end).withWatermark("day_end", lateness)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("userkey"), F.lit(BUCKETS)))
    device = logs.DEVICE

    def flush(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        # Written first, so that the state is asked once.
        store.append_epoch(batch, f"{out}/new", epoch)
        new = spark.read.schema(f"{SIGHTING}, {store.EPOCH} int").parquet(f"{out}/new").filter(F.col(store.EPOCH) == epoch).select(*device, "userkey", "ts", "seq")
        numbered = running_sum(new, device, [F.col("ts"), F.col("seq"), F.col("userkey")], F.lit(1).cast("long"), "users")
        days = store.touched(new, "dt")
        if not days:
            return
        totals = f"{out}/totals"
        before = store.read_snapshots(spark, totals, "dt", store.snapshot_epochs(spark, totals, "dt", [str(d) for d in days], before=epoch))
        if before is not None:
            known = before.select(*[F.col(c).alias(f"_{c}") for c in device], F.col("users").alias("_before"))
            same = F.lit(True)
            for c in device:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            numbered = numbered.join(known, same, "left").withColumn("users", F.col("users") + F.coalesce("_before", F.lit(0)))
        store.append_epoch(numbered.select(*device, "userkey", "ts", "seq", "users"), f"{out}/arrivals", epoch, ("dt",))
        written = spark.read.parquet(f"{out}/arrivals").filter(F.col(store.EPOCH) == epoch)
        store.merge_snapshot(written.groupBy(*device).agg(F.max("users").alias("users")), totals, "dt", device[1:], epoch)
        store.drop_superseded(spark, totals, "dt")
        store.drop_epochs(spark, f"{out}/new", epoch)

    with keyed_state(log_stream.sparkSession):
        firsts = rows.groupBy(*device, "bucket").transformWithState(FirstSightings(), SIGHTING, "Append", "EventTime")
        return _start(firsts, flush, checkpoint, "append", trigger, None)


def read_device_user_arrivals(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/arrivals").drop(store.EPOCH)
