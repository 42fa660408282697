"""Running sums and ranks of large keys against Spark's own windows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emporia.operators.running import PART, dealt_by_range, ranked, running_sum
from emporia.plans import logs


def rows_with_a_large_key(spark, n=3000):
    """A third of the rows under key 7, a third under null."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise((F.col("id") % 40).cast("int"))
    return spark.range(n).select(key.alias("k"), F.pmod(F.col("id") * 7919, F.lit(n)).alias("o"), (F.col("id") % 11 - 3).alias("v"))


def test_running_sum_equals_a_window(spark):
    df = rows_with_a_large_key(spark)
    for before in (False, True):
        got = running_sum(df, ["k"], [F.col("o")], F.col("v"), "s", before=before, parts=9)
        w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        want = df.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_large_key_lies_in_many_parts(spark):
    dealt = dealt_by_range(rows_with_a_large_key(spark), ["k"], [F.col("o")], 9)
    sizes = [r["count"] for r in dealt.groupBy(PART).count().collect()]
    assert len(sizes) == 9 and max(sizes) < 3000 / 3
    assert dealt.filter("k = 7").select(PART).distinct().count() >= 3


def test_ranks_of_a_large_group_with_ties(spark):
    df = rows_with_a_large_key(spark).withColumn("v", F.when(F.col("o") % 5 == 0, 0).when(F.col("o") % 17 == 0, None).otherwise(F.col("o") % 700))
    got = ranked(df, ["k"], "v", "r", parts=9)
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(F.desc("v"))))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_running_results_of_nothing(spark):
    none = rows_with_a_large_key(spark).limit(0)
    assert running_sum(none, ["k"], [F.col("o")], F.col("v"), "s").count() == 0
    assert ranked(none, ["k"], "v").count() == 0


def test_keyword_running_counts_with_a_hot_word(spark):
    rows = [(1_700_000_000 + i, i, "search", ["hot", " hot ", f"w{i % 5}", ""] if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "ts long, event_id long, log_type string, keywords array<string>")
    got = logs.keyword_running_counts(df, ("ts", "event_id")).collect()
    hot = sorted((r.event_id, r.pos, r.cnt) for r in got if r.keyword == "hot")
    assert [c for _, _, c in hot] == list(range(1, 401))
    assert not any(r.keyword == "" for r in got)
