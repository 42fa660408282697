"""Behaviour-log metrics M1-M5 (batch or stream, same transforms).

All start from log rows shaped like ``schemas.LOG_EVENT`` (``ts`` epoch in
seconds or milliseconds).  Rows with a null ``ts`` are dropped first, as in
every source job; dates are local dates in ``tz``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.text import PATH_ARROW, region_parts
from emporia.functions.time import DEFAULT_TZ, daily_window, epoch_ms, local_date, wall_clock
from emporia.operators.generators import explode_keywords
from emporia.operators.joins import ip_binary, ip_region_join, ipv4_to_long
from emporia.operators.ranking import top_n
from emporia.operators.running import running_sum
from emporia.operators.sequence import transitions


def normalise(df: DataFrame, tz: str = DEFAULT_TZ) -> DataFrame:
    """E5 + E1 + E3: drop null ``ts``, make it milliseconds, add ``log_date``."""
    return (
        df.filter(F.col("ts").isNotNull())
        .withColumn("ts", epoch_ms("ts"))
        .withColumn("log_date", local_date("ts", tz))
    )


def _by_day(df: DataFrame, lateness: str | None) -> tuple[DataFrame, list[str]]:
    """Grouping prefix for per-day aggregates.  With ``lateness`` (streams)
    the day's start becomes an event-time key with a watermark, so state
    for a day is dropped once the stream is that far past it; batch plans
    ignore the watermark."""
    if not lateness:
        return df, ["log_date"]
    df = df.withColumn("_day_ts", F.col("log_date").cast("timestamp")).withWatermark("_day_ts", lateness)
    return df, ["_day_ts", "log_date"]


def page_views(df: DataFrame, tz: str = DEFAULT_TZ, lateness: str | None = None) -> DataFrame:
    """M1: PV per (log_date, log_type); a null type is its own group."""
    rows, day = _by_day(normalise(df, tz), lateness)
    return rows.groupBy(*day, "log_type").agg(F.count(F.lit(1)).alias("pv")).drop("_day_ts")


def page_view_windows(df: DataFrame, tz: str = DEFAULT_TZ, lateness: str | None = None) -> DataFrame:
    """M1 as the source prints it (T7, F21): PV per type in one-day event-time windows aligned
    to local midnight, with the printed line.  With ``lateness`` (streams) a day is written
    once, when the watermark has passed its end.  Columns: log_date, log_type, pv, line."""
    rows = normalise(df, tz).withColumn("_t", F.timestamp_millis("ts"))
    rows = rows.withWatermark("_t", lateness) if lateness else rows
    counts = rows.groupBy(daily_window("_t", tz).alias("_w"), "log_type").agg(F.count(F.lit(1)).alias("pv"))
    day = F.to_date(wall_clock(F.col("_w.start"), tz))
    out = counts.select(day.alias("log_date"), "log_type", "pv")
    return out.withColumn("line", F.format_string("日期: %s, 页面: %s, PV: %d", F.col("log_date").cast("string"), "log_type", "pv"))


def keyword_counts(
    df: DataFrame, search_type: str = "search", tz: str = DEFAULT_TZ, lateness: str | None = None
) -> DataFrame:
    """A2: true count per (log_date, keyword) over search rows."""
    rows = normalise(df.filter(F.col("log_type") == search_type), tz)
    rows, day = _by_day(explode_keywords(rows.select("log_date", "keywords")), lateness)
    return rows.groupBy(*day, "keyword").agg(F.count(F.lit(1)).alias("cnt")).drop("_day_ts")


def keyword_running_counts(df: DataFrame, order: tuple[str, ...] = ("ts",), search_type: str = "search", tz: str = DEFAULT_TZ) -> DataFrame:
    """A2 as the source emits it: a row per keyword seen, with how often its day has had
    the keyword by then.  ``order`` tells rows apart (e.g. ts and an event id); the
    keywords of one row count in their order there.  Columns: log_date, keyword,
    ``order``, pos, cnt."""
    rows = normalise(df.filter(F.col("log_type") == search_type), tz)
    words = rows.select("log_date", *order, F.posexplode("keywords").alias("pos", "keyword"))
    words = words.withColumn("keyword", F.trim("keyword")).filter(F.length("keyword") > 0)
    return running_sum(words, ["log_date", "keyword"], [F.col(c) for c in (*order, "pos")], F.lit(1).cast("long"), "cnt")


def keyword_top_n(df: DataFrame, n: int = 10, search_type: str = "search", tz: str = DEFAULT_TZ) -> DataFrame:
    """Top-``n`` search words per day by count desc, then word asc.

    Columns: log_date, rn, keyword, cnt.
    """
    counts = keyword_counts(df, search_type, tz)
    return top_n(counts, ["log_date"], [F.desc("cnt"), F.asc("keyword")], n, "rn").select(
        "log_date", F.col("rn").cast("int").alias("rn"), "keyword", "cnt"
    )


def with_region(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """J8 + F15-F19: province, city and full_region for ``gis.ip``; IPv4 where the bounds of
    ``ranges`` are numbers, IPv6 too where they are 16 bytes."""
    as_range = ip_binary if isinstance(ranges.schema["start_ip"].dataType, T.BinaryType) else ipv4_to_long
    located = ip_region_join(df.withColumn("_ip", as_range(F.col("gis.ip"))), "_ip", ranges)
    province, city, full = region_parts("region")
    return located.withColumns({"province": province, "city": city, "full_region": full}).drop("_ip", "region")


def login_regions(
    df: DataFrame,
    ranges: DataFrame,
    login_type: str = "login",
    tz: str = DEFAULT_TZ,
    lateness: str | None = None,
) -> DataFrame:
    """M3: logins per (log_date, full_region).

    Rows without ``gis`` or with an empty ip are dropped; an ip outside every
    range counts as the unknown region.  The type filter runs before the
    lookup (the source ran it after).
    """
    rows = normalise(df.filter(F.col("log_type") == login_type), tz)
    rows = rows.filter(F.col("gis").isNotNull() & F.col("gis.ip").isNotNull() & (F.col("gis.ip") != ""))
    located, day = _by_day(with_region(rows.select("log_date", "gis"), ranges), lateness)
    return located.groupBy(*day, "full_region").agg(F.count(F.lit(1)).alias("logins")).drop("_day_ts")


def path_running_counts(df: DataFrame, order: tuple[str, ...] = ("ts",), tz: str = DEFAULT_TZ, bucket_ms: int = 3_600_000) -> DataFrame:
    """A4 as the source emits it: a row per page-type change, with how often its day has
    had the path by then.  Columns: log_date, path, ``order``, cnt.  ``order`` tells
    rows apart."""
    rows = normalise(df.filter(F.col("user_id").isNotNull()), tz).select("user_id", "log_type", "log_date", *order)
    paired = transitions(rows, "user_id", list(order), "log_type", F.floor(F.col("ts") / bucket_ms))
    path = F.concat("prev", F.lit(PATH_ARROW), "log_type").alias("path")
    moves = paired.filter(F.col("prev") != F.col("log_type")).select("log_date", path, *order)
    return running_sum(moves, ["log_date", "path"], [F.col(c) for c in order], F.lit(1).cast("long"), "cnt")


def path_transitions(
    df: DataFrame,
    tz: str = DEFAULT_TZ,
    order: tuple[str, ...] = ("ts",),
    bucket_ms: int = 3_600_000,
    slice_ms: int | None = None,
) -> DataFrame:
    """M4: count of page-type changes per (log_date, path).

    Per user in event-time order, each row paired with the row before it
    emits ``prev→type`` when both types are set and differ, dated by the
    later row.  ``order`` adds tie-breaks after ``ts`` (e.g. an event id).
    ``slice_ms`` (T8) pairs rows only inside per-user tumbling event-time
    slices of that length (the source used 10 s slices), so pairs that
    straddle a slice edge are not counted.  Rows without a user have no path.

    The rows are shuffled once, by (user, hour), for the pairs inside an hour.  Pairs
    across hours come from each hour's first and last row, an aggregate that leaves
    a row per user, hour and task, so no user's whole history meets in one task.
    """
    keys = list(dict.fromkeys(("ts",) + tuple(order)))
    rows = normalise(df.filter(F.col("user_id").isNotNull()), tz).select("user_id", "log_type", "log_date", *keys)
    rows = rows.withColumn("_b", F.floor(F.col("ts") / (slice_ms or bucket_ms)))
    inside = rows.withColumn("prev", F.lag("log_type").over(Window.partitionBy("user_id", "_b").orderBy(*keys)))
    pairs = inside.select("log_date", "prev", "log_type")
    if slice_ms is None:
        edge = F.struct(*keys, "log_date", "log_type")
        edges = rows.groupBy("user_id", "_b").agg(F.min(edge).alias("first"), F.max(edge).alias("last"))
        before = F.lag("last").over(Window.partitionBy("user_id").orderBy("_b"))
        across = edges.withColumn("_before", before)
        pairs = pairs.union(across.select("first.log_date", "_before.log_type", "first.log_type"))
    return count_moves(pairs)


def count_moves(paired: DataFrame) -> DataFrame:
    """Rows with ``prev`` -> count per (log_date, path) of type changes."""
    moves = paired.filter(
        F.col("prev").isNotNull() & F.col("log_type").isNotNull() & (F.col("prev") != F.col("log_type"))
    )
    return moves.groupBy("log_date", F.concat("prev", F.lit(PATH_ARROW), "log_type").alias("path")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


DEVICE = ["dt", "plat", "brand", "platv"]


def device_rows(df: DataFrame, *more: str, tz: str = DEFAULT_TZ) -> DataFrame:
    """Rows of M5: dt, plat, brand, platv, userkey and ``more``; no null userkey or plat."""
    device = F.col("device")
    rows = normalise(df, tz).filter(device.isNotNull() & F.col("device.userkey").isNotNull() & F.col("device.plat").isNotNull())
    return rows.select(F.col("log_date").alias("dt"), "device.plat", "device.brand", "device.platv", "device.userkey", *more)


def device_user_arrivals(df: DataFrame, order: tuple[str, ...] = ("ts",), tz: str = DEFAULT_TZ) -> DataFrame:
    """A5 as the source emits it: a row per new user of a (dt, plat, brand, platv), with the
    number of users it has had by then.  ``order`` tells rows apart.  Columns: dt, plat,
    brand, platv, userkey, ``order``, users."""
    rows = device_rows(df, *order, tz=tz)
    firsts = rows.groupBy(*DEVICE, "userkey").agg(F.min(F.struct(*order)).alias("_first"))
    firsts = firsts.select(*DEVICE, "userkey", *[F.col(f"_first.{c}").alias(c) for c in order])
    return running_sum(firsts, DEVICE, [*[F.col(c) for c in order], F.col("userkey")], F.lit(1).cast("long"), "users")


def device_users(df: DataFrame, tz: str = DEFAULT_TZ, approx_rsd: float | None = None) -> DataFrame:
    """M5: exact distinct users per (dt, plat, brand, platv).

    Null ``userkey`` or ``plat`` is dropped; null ``brand``/``platv`` form
    their own groups.  Spark plans the distinct as two aggregations keyed by
    (group, user) then group, both with map-side combine.  ``approx_rsd``
    switches to a HyperLogLog++ sketch with that relative standard
    deviation (one fixed-size sketch per group; no per-user shuffle).
    """
    rows = normalise(df, tz).filter(
        F.col("device").isNotNull() & F.col("device.userkey").isNotNull() & F.col("device.plat").isNotNull()
    )
    return rows.groupBy(
        F.col("log_date").alias("dt"),
        F.col("device.plat").alias("plat"),
        F.col("device.brand").alias("brand"),
        F.col("device.platv").alias("platv"),
    ).agg(
        (F.approx_count_distinct("device.userkey", approx_rsd) if approx_rsd else F.count_distinct("device.userkey"))
        .alias("users")
    )
