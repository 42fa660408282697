"""Change data: parse envelopes, merge snapshot and changes, current state.

Envelope fields: ``before``/``after`` row images, ``op`` in r (snapshot
read), c (insert), u (update), d (delete), ``ts_ms`` and ``source``
(schema, table, lsn).  With the default replica identity an update carries
no ``before`` and a delete carries only the key in ``before``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators.ranking import latest_by

SOURCE = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("lsn", T.LongType()),
    ]
)


def envelope(row: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("source", SOURCE),
        ]
    )


def parse_changes(df: DataFrame, row: T.StructType, col: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """JSON text -> envelope columns.  PERMISSIVE turns a bad line
    into nulls (dropped here); FAILFAST raises on it."""
    parsed = df.select(F.from_json(F.col(col), envelope(row), {"mode": mode}).alias("_e"))
    return parsed.filter(F.col("_e.op").isNotNull()).select("_e.*")


def filter_tables(df: DataFrame, schema: str = "public", table_pattern: str = ".*") -> DataFrame:
    """Keep changes of ``schema`` tables whose name matches the pattern."""
    return df.filter((F.col("source.schema") == schema) & F.col("source.table").rlike(f"^(?:{table_pattern})$"))


def flatten_change(df: DataFrame, row: T.StructType) -> DataFrame:
    """One flat record per change: the row image (after, else before),
    plus op, ts_ms, table and log position."""
    image = F.coalesce(F.col("after"), F.col("before"))
    return df.select(
        *[image[f.name].alias(f.name) for f in row.fields],
        "op",
        "ts_ms",
        F.col("source.table").alias("source_table"),
        F.col("source.lsn").alias("lsn"),
    )


def union_snapshot_changes(snapshot: DataFrame, changes: DataFrame, schema: str, table: str, ts_ms: int = 0, lsn: int = 0) -> DataFrame:
    """The initial snapshot of ``schema.table`` (as op 'r', at ``ts_ms`` and log position
    ``lsn``, where it was taken) followed by the change log."""
    row = T.StructType([snapshot.schema[c] for c in snapshot.columns])
    snap = snapshot.select(
        F.lit(None).cast(row).alias("before"),
        F.struct(*snapshot.columns).alias("after"),
        F.lit("r").alias("op"),
        F.lit(ts_ms).cast("long").alias("ts_ms"),
        F.struct(F.lit(schema).alias("schema"), F.lit(table).alias("table"), F.lit(lsn).cast("long").alias("lsn")).alias("source"),
    )
    return snap.unionByName(changes.select("before", "after", "op", "ts_ms", "source"))


MARKS = T.StructType([T.StructField("schema", T.StringType()), T.StructField("table", T.StringType()), T.StructField("lsn", T.LongType())])


def after_marks(changes: DataFrame, marks: DataFrame) -> DataFrame:
    """Changes that a table's snapshot does not hold yet: those above its high-water
    log position in ``marks`` (schema, table, lsn; the highest counts).  A table without a
    mark has no snapshot and keeps all its changes.

    ``marks`` has a row a table, and its own lookup in every task; a stream may join it,
    since it is static.  A change without a log position is kept.
    """
    high = marks.groupBy(F.col("schema").alias("_s"), F.col("table").alias("_t")).agg(F.max("lsn").alias("_high"))
    known = changes.join(high, (F.col("source.schema") == F.col("_s")) & (F.col("source.table") == F.col("_t")), "left")
    fresh = F.col("_high").isNull() | F.col("source.lsn").isNull() | (F.col("source.lsn") > F.col("_high"))
    return known.filter(fresh).select(*changes.columns)


def handover(snapshots: list[tuple[DataFrame, str, str, int]], changes: DataFrame, ts_ms: int = 0) -> DataFrame:
    """Snapshots (rows, schema, table, log position when taken), then the changes behind
    them, as one log.

    A reader starts following the log before the snapshot is taken, so changes between
    both are in the snapshot and in the log: they are dropped by position, and a change is
    neither lost nor applied twice.  Tables differ in their columns; rows of several are
    flattened one table at a time (``filter_tables``), as the image columns are those
    of ``changes``.
    """
    spark = changes.sparkSession
    marks = spark.createDataFrame([(s, t, lsn) for _, s, t, lsn in snapshots], MARKS)
    out = after_marks(changes.select("before", "after", "op", "ts_ms", "source"), marks)
    for rows, schema, table, lsn in snapshots:
        out = union_snapshot_changes(rows, out, schema, table, ts_ms, lsn)
    return out


def current_state(flat: DataFrame, keys: list[str], order: tuple[str, ...] = ("ts_ms", "lsn")) -> DataFrame:
    """C4: latest change per key, deleted keys removed.

    A max-by aggregate with map-side combine, so a key updated a billion
    times ships one candidate per task.
    """
    latest = latest_by(flat, keys, list(order))
    return latest.filter(F.col("op") != "d")
