"""Incremental ODS landing: extraction above a stored mark, merged into full days.

``dest`` holds, by load day ``dt``:

    inc/dt=...    the rows that the day's load found above the mark
    full/dt=...   the whole table as of the day: the day before, with those rows merged in
    marks/dt=...  the mark that the load reached

A load reads the mark and the full day before its own, so running it again gives the
same day, whether or not it (or a later one) has run before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.joins import null_safe_on
from emporia.operators.ranking import latest_by


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # Only a missing folder means "never loaded".
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _replace_day(df: DataFrame, path: str, dt: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/dt={dt}")


def last_load(spark: SparkSession, dest: str, before: str) -> tuple[str, object] | None:
    """(dt, mark) of the newest load of a day before ``before``."""
    marks = _read(spark, f"{dest}/marks")
    if marks is None:
        return None
    found = marks.select(F.col("dt").cast("string").alias("dt"), "mark").filter(F.col("dt") < before).orderBy(F.desc("dt")).limit(1).collect()
    return (found[0]["dt"], found[0]["mark"]) if found else None


def land_increment(source: DataFrame, dest: str, dt: str, keys: list[str], mark: str, deleted: str | None = None) -> dict:
    """Load day ``dt`` (yyyy-MM-dd) of ``source``; returns the marks it started from and reached.

    Rows with ``mark`` above the last mark are extracted (a filter that a Parquet or JDBC
    source evaluates itself); of several versions of a key the greatest ``mark`` wins, and
    ``deleted`` (a boolean column) removes the key.  ``mark`` must not fall; null marks are
    never extracted after the first load, which takes the whole table.  Keys may be null.
    The merge is one shuffle of both sides by key; a key of any number of versions is a
    row a task in it.
    """
    spark = source.sparkSession
    dest, columns = dest.rstrip("/"), source.columns
    last = last_load(spark, dest, dt)
    found = source.filter(F.col(mark) > F.lit(last[1])) if last else source
    _replace_day(found, f"{dest}/inc", dt)
    found = spark.read.schema(source.schema).parquet(f"{dest}/inc/dt={dt}")
    newest = latest_by(found, keys, [mark]).select(*columns)
    if last:
        rest = [c for c in columns if c not in keys]
        full = spark.read.schema(source.schema).parquet(f"{dest}/full/dt={last[0]}")
        old = full.select(*keys, F.struct(*rest).alias("_old"))
        new = newest.select(*keys, F.struct(*rest).alias("_new"))
        merged = null_safe_on(old, new, keys, "full_outer").select(*keys, F.coalesce("_new", "_old").alias("_row"))
        newest = merged.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in columns])
    if deleted:
        newest = newest.filter(~F.coalesce(F.col(deleted), F.lit(False)))
    _replace_day(newest, f"{dest}/full", dt)
    # The mark comes last: a load that fails before is run again from the same one.
    reached = found.agg(F.max(mark).alias("mark")).withColumn("mark", F.coalesce("mark", F.lit(last[1] if last else None)))
    _replace_day(reached.coalesce(1), f"{dest}/marks", dt)
    return {"from": last[1] if last else None, "to": spark.read.parquet(f"{dest}/marks/dt={dt}").first()["mark"]}


def read_full(spark: SparkSession, dest: str, dt: str) -> DataFrame:
    """The whole table as of day ``dt``."""
    return spark.read.parquet(f"{dest.rstrip('/')}/full/dt={dt}")
