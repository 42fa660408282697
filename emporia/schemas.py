"""Declared record schemas (no inference on streams)."""

from pyspark.sql import types as T

# Fixed values that must equal the wire format: sales change rows read by the
# cumulative GMV job (typed table with a derived event time).
SALES_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("sale_amount", T.DecimalType(10, 2)),
        T.StructField("sale_num", T.LongType()),
        T.StructField("total_amount", T.DecimalType(10, 2)),
        T.StructField("product_name", T.StringType()),
        T.StructField("ds", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("insert_time", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("cdc_timestamp", T.LongType()),
    ]
)

# Union of the behaviour-log fields the five metric jobs read.
LOG_EVENT = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("log_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("gis", T.StructType([T.StructField("ip", T.StringType())])),
        T.StructField(
            "device",
            T.StructType(
                [
                    T.StructField("userkey", T.StringType()),
                    T.StructField("brand", T.StringType()),
                    T.StructField("plat", T.StringType()),
                    T.StructField("platv", T.StringType()),
                ]
            ),
        ),
    ]
)

# IP range table standing in for the offline IP database.
IP_RANGES = T.StructType(
    [
        T.StructField("start_ip", T.LongType()),
        T.StructField("end_ip", T.LongType()),
        T.StructField("region", T.StringType()),
    ]
)

# Report table written from the GMV job (one row per window end).
REPORT_WINDOW_GMV = T.StructType(
    [
        T.StructField("ds", T.DateType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("win_gmv", T.DecimalType(38, 2)),
        T.StructField("top5_product_ids", T.StringType()),
    ]
)

PRODUCT_DETAIL = T.StructType(
    [T.StructField("product_id", T.StringType()), T.StructField("product_desc", T.StringType())]
)


def change_event(row: T.StructType) -> T.StructType:
    """Change-event envelope (before/after images, op, ts_ms, source)."""
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField(
                "source",
                T.StructType(
                    [T.StructField("schema", T.StringType()), T.StructField("table", T.StringType())]
                ),
            ),
        ]
    )
