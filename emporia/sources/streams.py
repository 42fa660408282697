"""Streaming sources: Kafka or file JSON logs, typed sales table.

The Kafka package is not bundled with Spark; ``kafka_options`` only builds
the option map, and a file source of JSON lines (or Parquet) stands in
for tests.  Every reader declares its schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.functions.time import event_time
from emporia.schemas import LOG_EVENT, SALES_EVENT


def kafka_options(
    servers: str, topic: str, group_id: str | None = None, starting: str = "earliest", fail_on_data_loss: bool = True
) -> dict:
    """Options for ``readStream.format('kafka')``.

    A fresh group id per run (the source appended the run's time) is what
    Spark does by default; pass ``group_id`` to pin one.  Offsets that have expired
    fail the query; ``fail_on_data_loss=False`` skips them.
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def read_text_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Raw JSON text as a ``value`` column from Kafka or a folder of files.

    ``source`` is ``{"format": "kafka", "options": {...}}`` or
    ``{"format": "text", "path": ..., "maxFilesPerTrigger": n}``.
    """
    fmt = source.get("format", "text")
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**source["options"]).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if "maxFilesPerTrigger" in source:
        reader = reader.option("maxFilesPerTrigger", source["maxFilesPerTrigger"])
    return reader.load(source["path"])


def parse_json(df: DataFrame, schema: T.StructType, mode: str = "skip", col: str = "value") -> DataFrame:
    """Parse JSON text with a declared schema.

    ``mode='fail'`` raises on a malformed record (FAILFAST); ``'skip'`` drops
    it; ``'null'`` keeps the row with null fields (a lenient table reader).
    """
    if mode == "fail":
        return df.select(F.from_json(F.col(col), schema, {"mode": "FAILFAST"}).alias("_r")).select("_r.*")
    parsed = df.select(F.col(col).alias("_raw"), F.from_json(F.col(col), schema).alias("_r"))
    if mode == "skip":
        # A malformed line parses to a struct of nulls; so does "{}".  Both
        # carry nothing a metric could use.
        any_field = F.lit(False)
        for f in schema.fields:
            any_field = any_field | F.col(f"_r.{f.name}").isNotNull()
        parsed = parsed.filter(F.col("_r").isNotNull() & any_field)
    return parsed.select("_r.*")


def read_log_stream(spark: SparkSession, source: dict, schema: T.StructType = LOG_EVENT, mode: str = "skip") -> DataFrame:
    """Behaviour-log stream parsed to ``schema``."""
    return parse_json(read_text_stream(spark, source), schema, mode)


def with_event_time(df: DataFrame) -> DataFrame:
    """Derived ``event_time`` (E2), an instant.  The job that aggregates owns the
    watermark; a stream may define it only once."""
    return df.withColumn("event_time", event_time("ts", "insert_time"))


def read_sales_stream(spark: SparkSession, source: dict) -> DataFrame:
    """Sales change rows with unparsable fields as nulls (other fields
    kept) and the derived event time."""
    return with_event_time(parse_json(read_text_stream(spark, source), SALES_EVENT, "null"))


def read_change_events(spark: SparkSession, source: dict, row: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """Change-event envelopes (before/after/op/ts_ms/source) from Kafka
    or files, e.g. as written by a log-based capture connector."""
    from emporia.plans.changes import parse_changes

    return parse_changes(read_text_stream(spark, source), row, "value", mode)
