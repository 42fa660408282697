"""Layered warehouse: DIM, DWD, DWS and ADS tables.

The source documents name the tables and metrics but give no SQL; each
formula is pinned in the docstring.  Every table is a groupBy/agg/join over
the layer below.  Distinct counts use one distinct column per aggregate so
Spark plans them as two hash aggregations (no Expand); dimension joins
are left to the planner.  Ratios are plain DOUBLE divisions,
null when the denominator is 0 or missing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.joins import null_safe_on, with_dimension
from emporia.operators.ranking import latest_by
from emporia.operators.running import ranked

PAGE_LOG = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("sku_id", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("search_word", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("ts", T.StringType()),
    ]
)
CHANNELS = ["app", "pc", "wx", "h5"]
# Behaviour stages of the customer-insight report and the log action for each.
STAGES = {"search": "click", "visit": "view", "pay": "purchase"}
ORDER_STATUS = {"O": "open", "P": "partial", "F": "finished"}
RATING = {"1": "good", "2": "neutral", "3": "bad"}


def money_sum(col: str) -> Column:
    """Money total as DECIMAL(38,4): exact, and wide enough for any table."""
    return F.sum(col).cast("decimal(38,4)")


def ratio(num, den) -> Column:
    """num / den as DOUBLE; null for a zero or null denominator."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


# ---- DIM ----------------------------------------------------------------------


def dim_sku(sku: DataFrame, category3: DataFrame, inventory: DataFrame) -> DataFrame:
    """Sku ⋈ category3 ⋈ inventory (left joins; stock 0 when absent)."""
    out = with_dimension(sku, category3, "category3_id").join(inventory, "sku_id", "left")
    return out.withColumn("stock", F.coalesce("stock", F.lit(0)))


def dim_user(users: DataFrame, as_of: str = "2024-01-31", new_days: int = 30) -> DataFrame:
    """Age in whole years at ``as_of``, ten-year age band, gender
    label, and new (created within ``new_days`` before ``as_of``) vs old."""
    ref = F.lit(as_of).cast("date")
    b = F.col("birthday")
    before_birthday = (F.month(ref) < F.month(b)) | ((F.month(ref) == F.month(b)) & (F.dayofmonth(ref) < F.dayofmonth(b)))
    age = F.year(ref) - F.year(b) - F.when(before_birthday, 1).otherwise(0)
    created = F.to_date("created_at")
    return users.select(
        "user_id",
        F.when(F.col("gender") == "M", "male").when(F.col("gender") == "F", "female").otherwise("unknown").alias("gender"),
        age.alias("age"),
        F.concat((F.floor(age / 10) * 10).cast("string"), F.lit("s")).alias("age_band"),
        F.when(created > F.date_sub(ref, new_days), "new").otherwise("old").alias("user_type"),
    )


def dim_activity(activity: DataFrame) -> DataFrame:
    """H4: activity dimension (projection with a duration)."""
    return activity.select(
        "activity_id",
        "activity_name",
        "start_date",
        "end_date",
        (F.datediff("end_date", "start_date") + 1).alias("days"),
    )


# ---- DWD ----------------------------------------------------------------------


def dwd_order_detail(
    lines: DataFrame, orders: DataFrame, payments: DataFrame, sku: DataFrame
) -> DataFrame:
    """Cleaned order lines joined to their order, with the sku's
    shop, category, brand and attribute, a paid flag (payment exists) and a
    refund flag.

    Cleaning drops lines without an order id or with a non-positive
    quantity and removes exact duplicate lines (line numbers alone are not
    unique in the source data, so a key-based dedupe would drop real
    lines); orders keep one version per order id (the latest).  Both are
    deduplicated before the join, so copies collapse map-side instead of
    meeting in the join's partition for their order; the order dedupe is
    keyed by order id, so the join reuses its partitioning.
    """
    clean = lines.filter(F.col("order_id").isNotNull() & (F.col("quantity") > 0) & F.col("amount").isNotNull())
    # One shuffle by order id serves the dedupe and both joins.
    clean = clean.repartition("order_id").dropDuplicates()
    current = latest_by(orders.filter(F.col("order_id").isNotNull()), ["order_id"], ["created_at"])
    out = clean.join(current, "order_id")
    paid = payments.select("order_id", F.lit(True).alias("is_paid")).dropDuplicates(["order_id"])
    out = out.join(paid, "order_id", "left")
    dims = sku.select("sku_id", "store_id", "category3_id", "brand", "attr_value")
    out = with_dimension(out, dims, "sku_id")
    return out.select(
        "order_id",
        "line_no",
        "user_id",
        "sku_id",
        "store_id",
        "category3_id",
        "brand",
        "attr_value",
        "quantity",
        "amount",
        F.coalesce("is_paid", F.lit(False)).alias("is_paid"),
        (F.col("return_flag") == "R").alias("is_refund"),
        F.to_date("created_at").alias("dt"),
    )


def dwd_order_info(orders: DataFrame, lines: DataFrame, payments: DataFrame) -> DataFrame:
    """H6: one clean row per order: its latest version, its status as a word, the number
    and amount of its clean lines (as in ``dwd_order_detail``; 0 without any), what was paid
    for it and whether that is all.

    Orders without an id are dropped.  Lines and payments are summed by order before they
    are joined, so an order of any number of lines is a row a task in the shuffle.
    """
    current = latest_by(orders.filter(F.col("order_id").isNotNull()), ["order_id"], ["created_at"])
    clean = lines.filter(F.col("order_id").isNotNull() & (F.col("quantity") > 0) & F.col("amount").isNotNull()).dropDuplicates()
    sums = clean.groupBy("order_id").agg(F.count(F.lit(1)).alias("line_num"), F.sum("quantity").alias("item_num"), money_sum("amount").alias("amount"))
    paid = dwd_payment_info(payments, orders).groupBy("order_id").agg(money_sum("amount").alias("paid_amount"))
    word = F.create_map(*[F.lit(x) for kv in ORDER_STATUS.items() for x in kv])[F.col("status")]
    out = current.join(sums, "order_id", "left").join(paid, "order_id", "left")
    return out.select(
        "order_id",
        "user_id",
        F.coalesce(word, F.lit("unknown")).alias("status"),
        F.coalesce("line_num", F.lit(0)).alias("line_num"),
        F.coalesce("item_num", F.lit(0)).alias("item_num"),
        F.coalesce("amount", F.lit(0)).cast("decimal(38,4)").alias("amount"),
        F.coalesce("paid_amount", F.lit(0)).cast("decimal(38,2)").alias("paid_amount"),
        F.col("paid_amount").isNotNull().alias("is_paid"),
        F.to_date("created_at").alias("dt"),
    )


def dwd_payment_info(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """H6: one clean row per payment, joined to its order: the latest version by payment id,
    positive amounts of done payments only, with the order's buyer and day.  A payment
    without an order keeps nulls there."""
    done = payments.filter(F.col("payment_id").isNotNull() & (F.col("amount") > 0) & (F.col("status") == "paid"))
    current = latest_by(done, ["payment_id"], ["paid_at"])
    bought = latest_by(orders.filter(F.col("order_id").isNotNull()), ["order_id"], ["created_at"])
    bought = bought.select("order_id", F.col("user_id").alias("buyer_id"), F.to_date("created_at").alias("order_dt"))
    return current.join(bought, "order_id", "left").select(
        "payment_id", "order_id", "user_id", "buyer_id", F.col("amount").cast("decimal(18,2)").alias("amount"), "order_dt", F.to_date("paid_at").alias("dt")
    )


def dwd_page_log(raw: DataFrame, sku: DataFrame, col: str = "line") -> DataFrame:
    """H8: JSON log lines -> typed page log with the sku's shop and category.

    Unparsable lines are dropped; a session is (user, local date).
    """
    rec = raw.select(F.from_json(F.col(col), PAGE_LOG).alias("r")).filter(F.col("r.action").isNotNull()).select("r.*")
    rec = rec.withColumn("ts", F.to_timestamp_ntz("ts")).withColumn("dt", F.to_date("ts"))
    rec = rec.withColumn("session_id", F.concat_ws("-", F.col("user_id").cast("string"), F.col("dt").cast("string")))
    return with_dimension(rec, sku.select("sku_id", "store_id", "category3_id", "brand"), "sku_id")


def dwd_action_detail(page_log: DataFrame, action: str) -> DataFrame:
    """H7: cart (click) / favor (signup) detail rows."""
    return page_log.filter(F.col("action") == action).select("user_id", "sku_id", "store_id", "brand", "dt")


def dwd_comment_detail(comments: DataFrame) -> DataFrame:
    """H7: comments with the rating code standardised to good/neutral/bad."""
    code = F.create_map(*[F.lit(x) for kv in RATING.items() for x in kv])[F.col("rating_code")]
    return comments.select(
        "comment_id", "sku_id", "user_id", F.coalesce(code, F.lit("unknown")).alias("rating"), F.to_date("created_at").alias("dt")
    )


# ---- DWS ----------------------------------------------------------------------


def dws_user_action_day_sum(page_log: DataFrame) -> DataFrame:
    """H9: actions per (dt, user, action)."""
    return page_log.groupBy("dt", "user_id", "action").agg(F.count(F.lit(1)).alias("action_count"))


def dws_order_day_sum(detail: DataFrame) -> DataFrame:
    """Orders, ordering users, items and amount per day."""
    per_order = detail.groupBy("dt", "order_id", "user_id").agg(
        F.sum("quantity").alias("items"), money_sum("amount").alias("amount")
    )
    return per_order.groupBy("dt").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("user_id").alias("user_count"),
        F.sum("items").alias("item_num"),
        money_sum("amount").alias("order_amount"),
    )


def dws_sku_sales_day_sum(detail: DataFrame) -> DataFrame:
    """Paid items, paying users, sales and orders with a refund per (dt, sku)."""
    paid = detail.filter("is_paid")
    return paid.groupBy("dt", "sku_id").agg(
        F.sum("quantity").alias("pay_item_num"),
        F.count_distinct("user_id").alias("pay_user_num"),
        money_sum("amount").alias("total_sales"),
        F.count_distinct(F.when(F.col("is_refund"), F.col("order_id"))).alias("refund_num"),
    )


def dws_comment_day_sum(comments: DataFrame) -> DataFrame:
    """Comments per (dt, sku) by rating."""
    return comments.groupBy("dt", "sku_id").agg(
        F.count(F.lit(1)).alias("comment_num"),
        *[F.sum((F.col("rating") == r).cast("int")).alias(f"{r}_num") for r in RATING.values()],
    )


def dws_favor_day_sum(favors: DataFrame) -> DataFrame:
    """Favorites and favoriting users per (dt, brand)."""
    return favors.groupBy("dt", "brand").agg(
        F.count(F.lit(1)).alias("favor_num"), F.count_distinct("user_id").alias("favor_user_num")
    )


def _visitors(page_log: DataFrame, keys: list[str], name: str = "visitor_count") -> DataFrame:
    views = page_log.filter((F.col("action") == "view") & F.col("user_id").isNotNull())
    return views.groupBy(*keys).agg(F.count_distinct("user_id").alias(name))


def _full(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on ``keys``; null keys meet."""
    return null_safe_on(left, right, keys, "full_outer")


def dws_store_category_daycount(page_log: DataFrame, detail: DataFrame) -> DataFrame:
    """Visitors, paying users, paid items, amount and pay rate per
    (dt, store, category3)."""
    keys = ["dt", "store_id", "category3_id"]
    sales = detail.filter("is_paid").groupBy(*keys).agg(
        F.count_distinct("user_id").alias("pay_user_count"),
        F.sum("quantity").alias("pay_item_num"),
        money_sum("amount").alias("payment_amount"),
    )
    out = _full(_visitors(page_log, keys), sales, keys)
    return out.withColumn("pay_rate", ratio("pay_user_count", "visitor_count"))


def dws_attr_distribution_analysis(
    page_log: DataFrame, detail: DataFrame, sku: DataFrame
) -> DataFrame:
    """By (dt, category3, attribute value): visitors, paying users,
    amount, conversion and ``action_num`` (skus with paid sales)."""
    keys = ["dt", "category3_id", "attr_value"]
    log = with_dimension(page_log, sku.select("sku_id", "attr_value"), "sku_id")
    paid = detail.filter("is_paid")
    users = paid.groupBy(*keys).agg(
        F.count_distinct("user_id").alias("payment_user_count"), money_sum("amount").alias("payment_amount")
    )
    skus = paid.groupBy(*keys).agg(F.count_distinct("sku_id").alias("action_num"))
    out = _full(_full(_visitors(log, keys), users, keys), skus, keys)
    return out.withColumn("conversion_rate", ratio("payment_user_count", "visitor_count"))


def dws_store_source_daycount(page_log: DataFrame) -> DataFrame:
    """Per (dt, store, source): visitors (view), cart (click), favor
    (signup) and paying (purchase) users, conversion = paying / visitors.
    Rows without a user are no visitors, as in every distinct user count."""
    keys = ["dt", "store_id", "source_type"]
    flags = page_log.filter(F.col("user_id").isNotNull()).groupBy(*keys, "user_id").agg(
        *[F.max((F.col("action") == a).cast("int")).alias(n) for n, a in
          [("v", "view"), ("c", "click"), ("f", "signup"), ("p", "purchase")]]
    )
    out = flags.groupBy(*keys).agg(
        F.sum("v").alias("visitor_count"),
        F.sum("c").alias("cart_user_count"),
        F.sum("f").alias("favor_user_count"),
        F.sum("p").alias("payment_user_count"),
    )
    return out.withColumn("conversion_rate", ratio("payment_user_count", "visitor_count"))


def dws_store_audience_daycount(
    detail: DataFrame, users: DataFrame, attribute: str
) -> DataFrame:
    """Paying users and amount per (dt, store, <user attribute>) for
    ``user_type`` (new/old), ``age_band`` or ``gender``."""
    paid = with_dimension(detail.filter("is_paid"), users.select("user_id", attribute), "user_id")
    return paid.groupBy("dt", "store_id", attribute).agg(
        F.count_distinct("user_id").alias("pay_user_count"), money_sum("amount").alias("payment_amount")
    )


def dws_keyword_traffic_analysis(page_log: DataFrame) -> DataFrame:
    """Visitors and searches per (dt, store, search word)."""
    searches = page_log.filter(F.col("search_word").isNotNull())
    return searches.groupBy("dt", "store_id", "search_word").agg(
        F.count_distinct("user_id").alias("visitor_count"), F.count(F.lit(1)).alias("search_count")
    )


# ---- DWS: distinct counts that merge -------------------------------------------
#
# A distinct count of two days is not the sum of their counts.  The day tables below
# hold what can be merged instead: any span of days is counted from them, without
# reading the log again.

LG_K = 14


def dws_visitor_sketch_day(page_log: DataFrame, dims: list[str], action: str = "view", lg_k: int = LG_K) -> DataFrame:
    """Per (dt, dims) an HLL sketch of the visitors, for ids of any type.

    A sketch is a few KB, whatever the day's size, and is built map-side.  The relative
    standard error of a count is about 0.83 / sqrt(2^lg_k): 0.65 % with 14.
    """
    rows = page_log.filter((F.col("action") == action) & F.col("user_id").isNotNull())
    return rows.groupBy("dt", *dims).agg(F.hll_sketch_agg("user_id", lg_k).alias("visitors"))


def visitors_about(day_table: DataFrame, dims: list[str], start: str, end: str) -> DataFrame:
    """(dims, visitors): about how many visitors the days ``start`` to ``end`` have together."""
    days = day_table.filter(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return days.groupBy(*dims).agg(F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("visitors"))


def dws_visitor_bitmap_day(page_log: DataFrame, dims: list[str], action: str = "view") -> DataFrame:
    """Per (dt, dims, bucket) a bitmap of the visitors whose ids (not negative) lie in the bucket
    of 32,768: exact, at most 4 KB a row, built map-side."""
    rows = page_log.filter((F.col("action") == action) & F.col("user_id").isNotNull())
    bucket = F.bitmap_bucket_number(F.col("user_id")).alias("bucket")
    return rows.groupBy("dt", *dims, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("user_id"))).alias("visitors"))


def visitors_exactly(day_table: DataFrame, dims: list[str], start: str, end: str) -> DataFrame:
    """(dims, visitors): how many visitors the days ``start`` to ``end`` have together."""
    days = day_table.filter(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    merged = days.groupBy(*dims, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("visitors")).alias("_n"))
    return merged.groupBy(*dims).agg(F.sum("_n").alias("visitors"))


# ---- ADS ----------------------------------------------------------------------


def sales_metrics(page_log: DataFrame, sku_sales: DataFrame) -> DataFrame:
    """H19 (ads_sku_conversion_sales_day): per (dt, sku): paying buyers,
    cart buyers, paid items, visitors and pay conversion = buyers / visitors."""
    keys = ["dt", "sku_id"]
    carts = page_log.filter((F.col("action") == "click") & F.col("user_id").isNotNull()).groupBy(*keys).agg(
        F.count_distinct("user_id").alias("cart_buyer_num")
    )
    sales = sku_sales.select(*keys, F.col("pay_user_num").alias("pay_buyer_num"), "pay_item_num")
    out = _full(_full(sales, carts, keys), _visitors(page_log, keys, "visitor_num"), keys)
    return out.withColumn("pay_conversion_rate", ratio("pay_buyer_num", "visitor_num"))


def traffic_metrics(page_log: DataFrame) -> DataFrame:
    """H20 (ads_sku_traffic_day): over page views (``action`` view), per day: unique
    visitors, sessions and jump rate = sessions with exactly one page view /
    sessions.  A session is one user's day, so one grouping gives all three; views
    without a user are one session of no visitor."""
    sessions = page_log.filter(F.col("action") == "view").groupBy("dt", "session_id", "user_id").agg(F.count(F.lit(1)).alias("pv"))
    out = sessions.groupBy("dt").agg(
        F.count("user_id").alias("total_uv"),
        F.count(F.lit(1)).alias("session_count"),
        F.sum((F.col("pv") == 1).cast("int")).alias("jump_sessions"),
    )
    return out.withColumn("jump_rate", ratio("jump_sessions", "session_count"))


def channel_pivot(page_log: DataFrame) -> DataFrame:
    """Page views (``action`` view) and their users per channel (app, pc, wx, h5)
    as columns, per day.  One grouping by (day, channel, user) feeds both numbers;
    the channel list is fixed, so no pass is needed to find it."""
    views = page_log.filter((F.col("action") == "view") & F.col("channel").isin(*CHANNELS))
    per_user = views.groupBy("dt", "channel", "user_id").agg(F.count(F.lit(1)).alias("pv"))
    on = {c: F.col("channel") == c for c in CHANNELS}
    return per_user.groupBy("dt").agg(
        *[F.coalesce(F.sum(F.when(on[c], F.col("pv"))), F.lit(0)).alias(f"{c}_pv") for c in CHANNELS],
        *[F.count(F.when(on[c], F.col("user_id"))).alias(f"{c}_uv") for c in CHANNELS],
    )


def price_metrics(sku_sales: DataFrame, conversion: DataFrame) -> DataFrame:
    """Per (dt, sku): paying users, orders with a refund, sales, items sold
    and the pay conversion rate of H19."""
    keys = ["dt", "sku_id"]
    conv = conversion.select(*keys, "pay_conversion_rate")
    sales = sku_sales.select(*keys, "pay_user_num", "refund_num", "total_sales", F.col("pay_item_num").alias("sale_num"))
    return null_safe_on(sales, conv, keys, "left")


def _staged(page_log: DataFrame, *keys: str) -> DataFrame:
    """Distinct users of each behaviour stage (search, visit, pay) per ``keys``."""
    stage = F.create_map(*[F.lit(x) for s, a in STAGES.items() for x in (a, s)])[F.col("action")]
    rows = page_log.select(*keys, stage.alias("stage"), "user_id")
    return rows.filter(F.col("stage").isNotNull() & F.col("user_id").isNotNull()).distinct()


def customer_insight(page_log: DataFrame, users: DataFrame) -> DataFrame:
    """Per (dt, category3, stage): the category's searchers, visitors or payers,
    their male and female share and new-to-old ratio."""
    keys = ["dt", "category3_id", "stage"]
    v = with_dimension(_staged(page_log, "dt", "category3_id"), users.select("user_id", "gender", "user_type"), "user_id")
    out = v.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_visitor_num"),
        F.sum((F.col("gender") == "male").cast("int")).alias("_m"),
        F.sum((F.col("gender") == "female").cast("int")).alias("_f"),
        F.sum((F.col("user_type") == "new").cast("int")).alias("_n"),
        F.sum((F.col("user_type") == "old").cast("int")).alias("_o"),
    )
    return out.select(
        *keys,
        "total_visitor_num",
        ratio("_m", "total_visitor_num").alias("male_ratio"),
        ratio("_f", "total_visitor_num").alias("female_ratio"),
        ratio("_n", "_o").alias("new_old_ratio"),
    )


def core_summary(store_category: DataFrame) -> DataFrame:
    """Amount, items, visitors and pay rate per (dt, store, category3)."""
    return store_category.select(
        "dt",
        "store_id",
        "category3_id",
        F.col("payment_amount"),
        F.col("pay_item_num").alias("payment_num"),
        "visitor_count",
        F.col("pay_rate"),
    )


def product_ranking(detail: DataFrame, category3_id: str | None = None, n: int | None = None) -> DataFrame:
    """Skus of a shop's category ranked by paid amount (rank, ties
    share a rank).  ``category3_id`` None ranks every category, none of which meets in one
    task; ``n`` keeps the first ranks only, which Spark cuts in every task before the
    shuffle."""
    paid = detail.filter("is_paid")
    if category3_id is not None:
        paid = paid.filter(F.col("category3_id") == category3_id)
    agg = paid.groupBy("store_id", "category3_id", "sku_id").agg(money_sum("amount").alias("payment_amount"))
    keys = ["store_id", "category3_id"]
    if n is None:
        return ranked(agg, keys, "payment_amount")
    w = Window.partitionBy(*keys).orderBy(F.desc("payment_amount"))
    return agg.withColumn("rk", F.rank().over(w)).filter(F.col("rk") <= n)


def month_of(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def gmv_target_progress(detail: DataFrame, targets: DataFrame) -> DataFrame:
    """Month-to-date paid GMV per shop against a target table
    (store_id, month, target_gmv); progress = gmv / target."""
    gmv = detail.filter("is_paid").groupBy("store_id", month_of(F.col("dt")).alias("month")).agg(
        money_sum("amount").alias("current_month_gmv")
    )
    out = gmv.join(targets, ["store_id", "month"], "left")
    return out.withColumn("progress", ratio("current_month_gmv", "target_gmv"))


def gmv_contribution(detail: DataFrame) -> DataFrame:
    """A category's share of its shop's paid GMV per month."""
    agg = detail.filter("is_paid").groupBy("store_id", month_of(F.col("dt")).alias("month"), "category3_id").agg(
        money_sum("amount").alias("category_gmv")
    )
    w = Window.partitionBy("store_id", "month")
    agg = agg.withColumn("store_gmv", F.sum("category_gmv").over(w))
    return agg.withColumn("share", ratio("category_gmv", "store_gmv"))


def category_rank(detail: DataFrame, month: str) -> DataFrame:
    """Rank of each category by paid amount within its shop for
    ``month`` (yyyy-MM)."""
    start = dt.date.fromisoformat(month + "-01")
    end = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    paid = detail.filter("is_paid").filter((F.col("dt") >= F.lit(start)) & (F.col("dt") < F.lit(end)))
    agg = paid.groupBy("store_id", "category3_id").agg(money_sum("amount").alias("payment_amount"))
    return ranked(agg, ["store_id"], "payment_amount")


def source_share(source_daycount: DataFrame) -> DataFrame:
    """Each traffic source's share of a shop's visitors, with its
    paying users and conversion."""
    w = Window.partitionBy("dt", "store_id")
    return source_daycount.select(
        "dt",
        "store_id",
        "source_type",
        "visitor_count",
        ratio(F.col("visitor_count"), F.sum("visitor_count").over(w)).alias("visitor_share"),
        "payment_user_count",
        "conversion_rate",
    )


def audience_ratio(page_log: DataFrame, users: DataFrame) -> DataFrame:
    """For each category, behaviour stage (search, visit, pay) and day, users and
    their share by gender, age band and new/old."""
    keys = ["dt", "category3_id", "stage"]
    u = with_dimension(_staged(page_log, "dt", "category3_id"), users.select("user_id", "gender", "age_band", "user_type"), "user_id")
    dims = F.array(*[F.struct(F.lit(a).alias("dimension"), F.col(a).alias("value")) for a in ("gender", "age_band", "user_type")])
    long = u.select(*keys, F.explode(dims).alias("d"))
    agg = long.groupBy(*keys, F.col("d.dimension").alias("dimension"), F.col("d.value").alias("value")).agg(
        F.count(F.lit(1)).alias("users")
    )
    w = Window.partitionBy(*keys, "dimension")
    return agg.withColumn("share", ratio(F.col("users"), F.sum("users").over(w)))


def ads_wide(sku_sales: DataFrame, comments: DataFrame, conversion: DataFrame) -> DataFrame:
    """One wide row per (dt, sku) from the DWS/ADS tables (left joins
    onto the conversion table, which holds every traffic or sales key)."""
    keys = ["dt", "sku_id"]
    wide = conversion.select(*keys, "visitor_num", "cart_buyer_num", "pay_buyer_num", "pay_conversion_rate")
    wide = null_safe_on(wide, sku_sales.select(*keys, "total_sales", "refund_num"), keys, "left")
    return null_safe_on(wide, comments.select(*keys, "comment_num", "good_num"), keys, "left")


def one_shot_ads(page_log: DataFrame, detail: DataFrame, comments: DataFrame) -> DataFrame:
    """The wide table straight from DWD in a single plan, no stored
    layers; must equal ``ads_wide``."""
    keys = ["dt", "sku_id"]
    log = page_log.filter(F.col("user_id").isNotNull()).groupBy(*keys, "user_id").agg(
        F.max((F.col("action") == "view").cast("int")).alias("v"), F.max((F.col("action") == "click").cast("int")).alias("c")
    )
    log = log.groupBy(*keys).agg(F.sum("v").alias("visitor_num"), F.sum("c").alias("cart_buyer_num"))
    log = log.select(
        *keys,
        F.when(F.col("visitor_num") > 0, F.col("visitor_num")).alias("visitor_num"),
        F.when(F.col("cart_buyer_num") > 0, F.col("cart_buyer_num")).alias("cart_buyer_num"),
    )
    paid = detail.filter("is_paid").groupBy(*keys).agg(
        F.count_distinct("user_id").alias("pay_buyer_num"),
        money_sum("amount").alias("total_sales"),
        F.count_distinct(F.when(F.col("is_refund"), F.col("order_id"))).alias("refund_num"),
    )
    com = comments.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("comment_num"), F.sum((F.col("rating") == "good").cast("int")).alias("good_num")
    )
    out = log.filter(F.col("visitor_num").isNotNull() | F.col("cart_buyer_num").isNotNull())
    out = null_safe_on(null_safe_on(out, paid, keys, "full_outer"), com, keys, "left")
    return out.select(
        *keys,
        "visitor_num",
        "cart_buyer_num",
        "pay_buyer_num",
        ratio("pay_buyer_num", "visitor_num").alias("pay_conversion_rate"),
        "total_sales",
        "refund_num",
        "comment_num",
        "good_num",
    )


def drilldown_summary(detail: DataFrame) -> DataFrame:
    """Month summary rows (orders, amount) for the drill-down report."""
    return detail.groupBy(month_of(F.col("dt")).alias("month")).agg(
        F.count_distinct("order_id").alias("order_count"), money_sum("amount").alias("order_amount")
    )


def drilldown_detail(detail: DataFrame, day: str) -> DataFrame:
    """The detail rows behind one day of the summary; on a detail table stored
    by ``dt`` only that day's folder is read."""
    return detail.filter(F.col("dt") == F.lit(dt.date.fromisoformat(day)))


def gmv_targets(spark: SparkSession, stores: DataFrame, month: str, per_store: int = 100_000) -> DataFrame:
    """A target table: ``per_store * (store_id + 1)`` for each shop."""
    return stores.select(
        "store_id", F.lit(month).alias("month"), ((F.col("store_id") + 1) * per_store).cast("decimal(18,2)").alias("target_gmv")
    )
