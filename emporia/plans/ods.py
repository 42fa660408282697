"""ODS landing tables derived from the driver tables (H1).

Mapping: sku = part (the sku's shop is ``p_partkey % 10``), user =
customer, store = supplier, orders = orders, order lines = lineitem, payment =
orders in status F, comments = one per order line, page log = events
(as JSON lines).  Order dates (1995-2001) are folded into the events'
month, ``2024-01-01 + (days since 1995-01-01) % 30``, so traffic and
sales share days.  Every rule is repeated in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.sources.tables import table

STORES = 10
CHANNELS = ["app", "pc", "wx", "h5"]
SOURCES = ["search", "recommend", "ad", "direct"]


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def size_band(size: Column) -> Column:
    return F.when(size <= 15, "S").when(size <= 35, "M").otherwise("L")


def ods_sku_info(spark: SparkSession, base: str) -> DataFrame:
    p = table(spark, base, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    return p.select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("p_type").alias("category3_id"),
        F.col("p_brand").alias("brand"),
        size_band(F.col("p_size")).alias("attr_value"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        F.pmod("p_partkey", F.lit(STORES)).alias("store_id"),
    )


def ods_base_category3(spark: SparkSession, base: str) -> DataFrame:
    p = table(spark, base, "part", ["p_type"])
    # Unique on category3_id, so a join that uses no category column is pruned.
    return p.groupBy(F.col("p_type").alias("category3_id")).agg(F.min(F.lower("p_type")).alias("category3_name"))


def ods_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Stock per sku: total quantity on order lines."""
    li = table(spark, base, "lineitem", ["l_partkey", "l_quantity"])
    return li.groupBy(F.col("l_partkey").alias("sku_id")).agg(F.sum("l_quantity").cast("long").alias("stock"))


def ods_user_info(spark: SparkSession, base: str) -> DataFrame:
    c = table(spark, base, "customer", ["c_custkey"])
    key = F.col("c_custkey")
    return c.select(
        key.alias("user_id"),
        F.when(F.pmod(key, F.lit(2)) == 0, "M").otherwise("F").alias("gender"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.pmod(key * 37, F.lit(18000)).cast("int")).alias("birthday"),
        F.date_add(F.lit("2023-11-15").cast("date"), F.pmod(key, F.lit(90)).cast("int"))
        .cast("timestamp_ntz")
        .alias("created_at"),
    )


def ods_store_info(spark: SparkSession, base: str) -> DataFrame:
    s = table(spark, base, "supplier", ["s_suppkey", "s_name"])
    return s.select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"))


def _order_time(d: Column) -> Column:
    days = F.pmod(F.datediff(F.to_date(d), F.lit("1995-01-01").cast("date")), F.lit(30))
    return F.date_add(F.lit("2024-01-01").cast("date"), days).cast("timestamp_ntz")


def ods_order_info(spark: SparkSession, base: str) -> DataFrame:
    """Orders (one row per order in the source system)."""
    o = table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        _order_time(F.col("o_orderdate")).alias("created_at"),
    )


def ods_order_detail(spark: SparkSession, base: str) -> DataFrame:
    """Order lines; amount = price * (1 - discount), exact in DECIMAL."""
    li = table(
        spark, base, "lineitem",
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"],
    )
    amount = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(18,2)"))
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        amount.cast("decimal(18,4)").alias("amount"),
        F.col("l_returnflag").alias("return_flag"),
    )


def ods_payment_info(spark: SparkSession, base: str) -> DataFrame:
    o = table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    return o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.lit("paid").alias("status"),
        _order_time(F.col("o_orderdate")).alias("paid_at"),
    )


def ods_comment_info(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """One comment per order line by the order's buyer on the order's day;
    rating code 1-3 from the line number."""
    return lines.join(orders.select("order_id", "user_id", "created_at"), "order_id").select(
        (F.col("order_id") * 8 + F.col("line_no")).alias("comment_id"),
        "sku_id",
        "user_id",
        (F.pmod("line_no", F.lit(3)) + 1).cast("string").alias("rating_code"),
        "created_at",
    )


def ods_page_log(spark: SparkSession, base: str) -> DataFrame:
    """Raw behaviour log as JSON text (column ``line``).

    The rows are dealt out first: a file of few row groups would be written as JSON, and
    parsed by what reads it, in as few tasks.
    """
    ev = table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "props"]).repartition("event_id", "ts")
    k = _k()
    rec = F.struct(
        F.col("user_id").alias("user_id"),
        k.alias("sku_id"),
        F.element_at(F.array(*map(F.lit, CHANNELS)), (F.pmod("event_id", F.lit(4)) + 1).cast("int")).alias("channel"),
        F.element_at(F.array(*map(F.lit, SOURCES)), (F.pmod(k, F.lit(4)) + 1).cast("int")).alias("source_type"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("w"), F.pmod(k, F.lit(10)).cast("string"))).alias(
            "search_word"
        ),
        F.col("event_type").alias("action"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
    )
    return ev.select(F.to_json(rec).alias("line"))
