"""Adapters from the driver's tables to the reference's inputs.

The driver tables carry no keywords, IPs, devices, stores or genders, so
these are derived by fixed arithmetic on existing columns.  The same rules
are written in the DuckDB oracle, so both sides see identical inputs.
``events.props`` holds ``{"k": <int>}``; ``k`` serves as product id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.time import ntz_epoch_ms
from emporia.functions.text import MISSING
from emporia.sources.tables import table

# Multiplier spreading user ids over the IPv4 space (Knuth's hash).
IP_HASH = 2654435761


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def events(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "events", EVENT_COLS)


def events_stream(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """``events`` as a file stream (the glob keeps the file source on the one
    table even though the folder holds every table)."""
    schema = spark.read.parquet(f"{base}/events.parquet").select(*EVENT_COLS).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{base}/events.parque[t]")


def sales_events(spark: SparkSession, base: str) -> DataFrame:
    return sales_rows(events(spark, base))


def sales_rows(ev: DataFrame, *more: str) -> DataFrame:
    """Purchases as sales rows: id = user_id, product = k, amount = value."""
    return ev.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").cast("string").alias("id"),
        _k().cast("string").alias("product_id"),
        F.col("value").alias("total_amount"),
        F.col("ts").alias("event_time"),
        *more,
    )


def log_events(spark: SparkSession, base: str) -> DataFrame:
    return log_rows(events(spark, base))


def log_rows(ev: DataFrame) -> DataFrame:
    """Behaviour-log rows from ``events``.

    ``ts`` is epoch seconds for even event ids and milliseconds for odd ones
    (the events' wall clock read as UTC), null when ``value`` is below 1.
    log_type = event_type; clicks carry keywords ``[k, ' ' || k%10, '']``;
    gis.ip is a dotted address hashed from user_id; device fields come from
    user_id and k, with some nulls.
    """
    ms = ntz_epoch_ms("ts", "UTC")
    k = _k()
    ipn = F.pmod(F.col("user_id") * F.lit(IP_HASH), F.lit(1 << 32))
    ip = F.concat_ws(
        ".",
        F.shiftright(ipn, 24).cast("string"),
        F.pmod(F.shiftright(ipn, 16), F.lit(256)).cast("string"),
        F.pmod(F.shiftright(ipn, 8), F.lit(256)).cast("string"),
        F.pmod(ipn, F.lit(256)).cast("string"),
    )
    plat = F.when(F.pmod("user_id", F.lit(5)) == 0, F.lit(None)).when(
        F.pmod("user_id", F.lit(2)) == 0, F.lit("ios")
    ).otherwise(F.lit("android"))
    brand = F.when(F.pmod(k, F.lit(7)) == 0, F.lit(None)).otherwise(
        F.concat(F.lit("brand"), F.pmod(k, F.lit(4)).cast("string"))
    )
    platv = F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None)).otherwise(
        F.concat(F.lit("v"), F.pmod(F.col("user_id"), F.lit(3)).cast("string"))
    )
    userkey = F.when(F.pmod("user_id", F.lit(9)) == 0, F.lit(None)).otherwise(
        F.concat(F.lit("u"), F.col("user_id").cast("string"))
    )
    keywords = F.when(
        F.col("event_type") == "click",
        F.array(k.cast("string"), F.concat(F.lit(" "), F.pmod(k, F.lit(10)).cast("string")), F.lit("")),
    )
    return ev.select(
        "event_id",
        F.when(F.col("value") < 1, F.lit(None))
        .when(F.pmod("event_id", F.lit(2)) == 0, F.floor(ms / 1000))
        .otherwise(ms)
        .cast("long")
        .alias("ts"),
        F.col("event_type").alias("log_type"),
        F.col("user_id").cast("string").alias("user_id"),
        keywords.alias("keywords"),
        F.struct(ip.alias("ip")).alias("gis"),
        F.struct(userkey.alias("userkey"), brand.alias("brand"), plat.alias("plat"), platv.alias("platv")).alias(
            "device"
        ),
    )


def sales_json(spark: SparkSession, base: str) -> DataFrame:
    """Sales change rows as JSON lines (column ``value``) derived from ``events``: ts in
    seconds for even event ids, else null with insert_time in milliseconds; op by
    event type as in ``SALES_OPS``."""
    ms = ntz_epoch_ms("ts", "UTC")
    op = F.create_map(*[F.lit(x) for kv in SALES_OPS.items() for x in kv])[F.col("event_type")]
    row = F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").cast("string").alias("order_id"),
        _k().cast("string").alias("product_id"),
        F.col("value").cast("decimal(10,2)").alias("total_amount"),
        F.when(F.pmod("event_id", F.lit(2)) == 0, F.floor(ms / 1000).cast("string")).alias("ts"),
        ms.alias("insert_time"),
        op.alias("op"),
    )
    return events(spark, base).select(F.to_json(row).alias("value"))


def ip_ranges(spark: SparkSession, base: str) -> DataFrame:
    """One IP range per nation: [n * 2^27, n * 2^27 + 2^26 - 1]; the rest of
    the space is unmatched.  Region text by ``n % 5``: province only,
    province+city, autonomous region, municipality, and a foreign row."""
    n = table(spark, base, "nation", ["n_nationkey", "n_name"])
    key = F.col("n_nationkey").cast("long")
    name = F.col("n_name")
    region = (
        F.when(F.pmod(key, F.lit(5)) == 0, F.concat(F.lit("中国|0|"), name, F.lit("省|"), name, F.lit("|电信")))
        .when(F.pmod(key, F.lit(5)) == 1, F.concat(F.lit("中国|0|"), name, F.lit("省"), name, F.lit("市|x")))
        .when(F.pmod(key, F.lit(5)) == 2, F.concat(F.lit("中国|0|"), name, F.lit("自治区|x")))
        .when(F.pmod(key, F.lit(5)) == 3, F.concat(F.lit("中国|0|"), name, F.lit("市|x")))
        .otherwise(F.lit("美国|0|0|x"))
    )
    return n.select(
        (key * (1 << 27)).alias("start_ip"),
        (key * (1 << 27) + (1 << 26) - 1).alias("end_ip"),
        region.alias("region"),
    )


def report_table(gmv_report: DataFrame) -> DataFrame:
    """GMV report rows as the report table, with the missing-data sentinel
    injected: on days of month divisible by 7 the list is the sentinel
    alone, on days divisible by 5 the sentinel leads the list."""
    dom = F.dayofmonth("window_start")
    ids = (
        F.when(dom % 7 == 0, F.lit(MISSING))
        .when(dom % 5 == 0, F.concat(F.lit(MISSING + ","), F.col("top5_product_ids")))
        .otherwise(F.col("top5_product_ids"))
    )
    return gmv_report.select(
        F.to_date("window_start").alias("ds"),
        "window_start",
        "window_end",
        F.col("gmv").alias("win_gmv"),
        ids.alias("top5_product_ids"),
    )


def product_detail(spark: SparkSession, base: str) -> DataFrame:
    """Product dimension: part key as id, part name as description."""
    p = table(spark, base, "part", ["p_partkey", "p_name"])
    return p.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("product_desc"))


def sales_strings(spark: SparkSession, base: str) -> DataFrame:
    """Sales-table style string epochs from ``events`` (for E2).

    By ``event_id % 6``: seconds, seconds with a 3-digit fraction,
    milliseconds, empty, null (both fall back to insert_time in ms), and
    unparsable text.
    """
    ev = table(spark, base, "events", ["event_id", "ts"])
    ms = ntz_epoch_ms("ts", "UTC")
    sec = F.floor(ms / 1000).cast("string")
    frac = F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0")
    m = F.pmod("event_id", F.lit(6))
    ts = (
        F.when(m == 0, sec)
        .when(m == 1, F.concat(sec, F.lit("."), frac))
        .when(m == 2, ms.cast("string"))
        .when(m == 3, F.lit(""))
        .when(m == 4, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("t"), F.col("event_id").cast("string")))
    )
    return ev.select("event_id", ts.alias("ts"), ms.alias("insert_time"))


# Row image carried by the derived change log.
CHANGE_ROW = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
CHANGE_OPS = {"signup": "c", "view": "u", "click": "u", "error": "d", "purchase": "r"}


def change_log(spark: SparkSession, base: str) -> DataFrame:
    return change_rows(events(spark, base))


def change_rows(ev: DataFrame) -> DataFrame:
    """Change-event JSON lines (column ``value``) derived from ``events``.

    op by event type (signup c, view/click u, error d, purchase r); key
    user_id; ts_ms from ts; log position = event_id.  Updates carry no
    before image and deletes carry only the key, as with a default replica
    identity.
    """
    op = F.create_map(*[F.lit(x) for kv in CHANGE_OPS.items() for x in kv])[F.col("event_type")]
    image = F.struct("user_id", "event_type", "value")
    env = F.struct(
        F.when(op == "d", F.struct("user_id", F.lit(None).cast("string").alias("event_type"),
                                   F.lit(None).cast("double").alias("value"))).alias("before"),
        F.when(op != "d", image).alias("after"),
        op.alias("op"),
        ntz_epoch_ms("ts", "UTC").alias("ts_ms"),
        F.struct(F.lit("public").alias("schema"), F.lit("events").alias("table"),
                 F.col("event_id").alias("lsn")).alias("source"),
    )
    return ev.select(F.to_json(env).alias("value"))


# Change ops given to events for the sales view (E10), and the day it keeps.
SALES_OPS = {"purchase": "r", "view": "+I", "click": "+U", "signup": "-U", "error": "-D"}
SALES_DAY = "2024-01-15"


# ---- arrivals, snapshots, ranges ----------------------------------------------------

LOTS = 4


def sales_lots(spark: SparkSession, base: str) -> DataFrame:
    """Sales rows with ``lot``, the ten days in which they arrive: every 13th event a day after
    it happened, every 101st nine days after, the others at once."""
    ev = events(spark, base).filter(F.col("event_type") == "purchase")
    late = F.when(F.pmod("event_id", F.lit(101)) == 0, 9).when(F.pmod("event_id", F.lit(13)) == 0, 1).otherwise(0)
    lot = F.least(F.floor((F.datediff("ts", F.lit("2024-01-01").cast("date")) + late) / 10).cast("int"), F.lit(LOTS - 1))
    return sales_rows(ev.withColumn("lot", lot), "lot")


def arrival_logs(spark: SparkSession, base: str) -> DataFrame:
    """Log rows with ``arrived``, 20 a second in the order of their ids, and a last row a day
    later that stands for the end of the input (its type is null, so it is in no path)."""
    start = F.lit("2024-03-01 00:00:00").cast("timestamp")
    rows = log_rows(events(spark, base)).select("event_id", "ts", "log_type", "user_id", F.timestamp_add("MILLISECOND", F.col("event_id") * 50, start).alias("arrived"))
    last = rows.agg(F.max("arrived").alias("arrived")).select(
        F.lit(-1).cast("long").alias("event_id"), F.lit(0).cast("long").alias("ts"), F.lit(None).cast("string").alias("log_type"), F.lit("end").alias("user_id"),
        F.timestamp_add("DAY", F.lit(1), F.col("arrived")).alias("arrived"),
    )
    return rows.unionByName(last)


def taken_at(spark: SparkSession, base: str) -> int:
    """The log position at which the snapshot of the change log is taken: half way."""
    return (events(spark, base).agg(F.max("event_id")).first()[0] or 0) // 2


def wide_ranges(spark: SparkSession, base: str) -> DataFrame:
    """Overlapping ranges, one per part, of widths from 1 to 2^31, and one over all addresses."""
    p = table(spark, base, "part", ["p_partkey"])
    key = F.col("p_partkey").cast("long")
    start = F.pmod(key * F.lit(IP_HASH), F.lit(1 << 32))
    end = F.least(start + F.expr("shiftleft(1L, int(p_partkey % 32))") - 1, F.lit((1 << 32) - 1))
    rows = p.select(start.alias("start_ip"), end.alias("end_ip"), F.concat(F.lit("r"), key.cast("string")).alias("region"))
    return rows.unionByName(spark.range(1).select(F.lit(0).cast("long").alias("start_ip"), F.lit((1 << 32) - 1).alias("end_ip"), F.lit("all").alias("region")))


def hex16(high: Column, fill: str) -> Column:
    """16 bytes: ``high`` (not negative) and eight bytes of one hexadecimal digit."""
    return F.concat(F.lpad(F.hex(high), 16, "0"), F.lit(fill * 16))


def wide_ranges_v6(spark: SparkSession, base: str) -> DataFrame:
    """IPv6 ranges from those of ``wide_ranges``: prefixes 2001:db8::/32 and on."""
    r = wide_ranges(spark, base)
    top = F.lit(0x20010DB8 << 32)
    return r.select(F.unhex(hex16(top + F.col("start_ip"), "0")).alias("start_ip"), F.unhex(hex16(top + F.col("end_ip"), "F")).alias("end_ip"), "region")


def address_rows(spark: SparkSession, base: str) -> DataFrame:
    """(event_id, ip, ip6): an IPv4 address as a number, an IPv6 one as text; every 7th event
    has none."""
    ev = table(spark, base, "events", ["event_id"])
    n = F.when(F.pmod("event_id", F.lit(7)) != 0, F.pmod((F.col("event_id") + 17) * F.lit(IP_HASH), F.lit(1 << 32)))
    ip6 = F.concat(F.lit("2001:db8:"), F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(F.pmod(n, F.lit(65536)))), F.lit("::"), F.lower(F.hex(F.pmod("event_id", F.lit(65536)))))
    return ev.select("event_id", n.alias("ip"), ip6.alias("ip6"))
