"""Sinks: JSON to Kafka/files, console, layered Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

LAYERS = ("ods", "dim", "dwd", "dws", "ads")


def as_json_value(df: DataFrame) -> DataFrame:
    """One JSON object per row in a ``value`` column (null key)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_json_stream(df: DataFrame, sink: dict, checkpoint: str) -> DataStreamWriter:
    """S3: append JSON rows to Kafka (``acks=all``; no key, so the producer
    spreads records over partitions) or to a folder of JSON files.

    ``sink`` is ``{"format": "kafka", "servers": ..., "topic": ...}`` or
    ``{"format": "json", "path": ...}``.  Returns the unstarted writer.
    """
    out = as_json_value(df)
    if sink.get("format") == "kafka":
        w = (
            out.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", sink["servers"])
            .option("topic", sink["topic"])
            .option("kafka.acks", "all")
        )
    else:
        w = out.writeStream.format("text").option("path", sink["path"])
    return w.option("checkpointLocation", checkpoint).outputMode("append")


def send_json(df: DataFrame, sink: dict) -> None:
    """S3 for one micro-batch: its rows as JSON to a topic or, appended, to a folder."""
    out = as_json_value(df)
    if sink.get("format") == "kafka":
        out.write.format("kafka").option("kafka.bootstrap.servers", sink["servers"]).option("topic", sink["topic"]).option("kafka.acks", "all").save()
    else:
        out.write.mode("append").text(sink["path"])


def to_console(df: DataFrame, mode: str = "update", rows: int = 50) -> DataStreamWriter:
    """Print each micro-batch (debugging only)."""
    return df.writeStream.format("console").outputMode(mode).option("numRows", rows).option("truncate", "false")


def write_json(df: DataFrame, path: str) -> None:
    """Write records as JSON lines."""
    df.write.mode("overwrite").json(path)


def write_ods(df: DataFrame, dest: str, fmt: str = "json", dt_col: str = "dt", mode: str = "overwrite") -> None:
    """Land raw records partitioned by day.

    ``mode='overwrite'`` replaces only the days present in ``df`` (dynamic
    partition overwrite), which makes a daily incremental load re-runnable;
    ``'append'`` adds files.
    """
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(dt_col)
        .format(fmt)
        .save(dest)
    )


def write_layer(
    df: DataFrame, base: str, layer: str, table: str, dt_col: str | None = "dt", compression: str = "zstd"
) -> str:
    """Write a DIM/DWD/DWS/ADS table as Parquet under ``base/layer/table``.

    Day-partitioned tables overwrite only the days written, so reloading a
    day is idempotent and readers prune partitions by ``dt``.
    """
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of {LAYERS}")
    path = f"{base.rstrip('/')}/{layer}/{table}"
    w = df.write.mode("overwrite").option("compression", compression)
    if dt_col:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(dt_col)
    w.parquet(path)
    return path
