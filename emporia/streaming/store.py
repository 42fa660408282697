"""A replay-safe per-key result store fed from ``foreachBatch``.

Each micro-batch writes its rows under ``_epoch=<batch id>`` with dynamic
partition overwrite, so a batch replayed after a failure replaces its own
files instead of adding to them.  Readers take the latest row per key
(for streams that emit full values, e.g. ``update`` mode aggregates) or the
sum per key (for streams that emit increments).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.ranking import latest_by

EPOCH = "_epoch"


def append_epoch(df: DataFrame, path: str, epoch_id: int, partition_cols: tuple[str, ...] = ()) -> None:
    (
        df.withColumn(EPOCH, F.lit(int(epoch_id)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols, EPOCH)
        .parquet(path)
    )


def latest(spark: SparkSession, path: str, keys: list[str], order: list[str] | None = None, where=None) -> DataFrame:
    """Latest row per key; ``order`` defaults to the batch id."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    out = latest_by(df, keys, order or [EPOCH])
    return out.drop(EPOCH)


def summed(spark: SparkSession, path: str, keys: list[str], measures: list[str], where=None) -> DataFrame:
    """Sum of increments per key."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def touched(batch: DataFrame, col: str) -> list:
    """Distinct values of a partition column in one micro-batch (a few days)."""
    return [r[0] for r in batch.select(col).distinct().collect()]


# ---- per-partition snapshots -------------------------------------------------
#
# Jobs that must see *all* rows of the partitions (days) a batch touched use
# snapshots instead of deltas: batch ``e`` merges each touched day's newest
# snapshot older than ``e`` with its own rows and writes the result as the
# day's snapshot at ``e``.  A batch reads one snapshot per day, however many
# batches came before; a replayed batch reads the snapshot before its own
# epoch and overwrites its own output.  Superseded snapshot folders are
# never read again; ``drop_superseded`` removes them.


def snapshot_epochs(spark: SparkSession, path: str, part: str, values: list, before: int | None = None) -> dict:
    """Newest snapshot epoch (< ``before``) of each partition value, from
    the file listing of those partitions only (no data is read)."""
    import re

    out = {}
    for v in values:
        folder = f"{path.rstrip('/')}/{part}={v}"
        try:
            files = spark.read.parquet(folder).inputFiles()
        except AnalysisException as e:
            # Only a missing folder means "no snapshot yet"; any other failure
            # must fail the batch, or it would overwrite the day with its own rows.
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        epochs = {int(m.group(1)) for f in files for m in [re.search(rf"/{EPOCH}=(\d+)/", f)] if m}
        epochs = {e for e in epochs if before is None or e < before}
        if epochs:
            out[str(v)] = max(epochs)
    return out


def read_snapshots(spark: SparkSession, path: str, part: str, epochs: dict) -> DataFrame | None:
    """Rows of the given (partition value -> epoch) snapshots; partition
    pruning limits the scan to exactly those folders."""
    if not epochs:
        return None
    cond = None
    for v, e in epochs.items():
        c = (F.col(part).cast("string") == F.lit(v)) & (F.col(EPOCH) == F.lit(e))
        cond = c if cond is None else cond | c
    return spark.read.parquet(path).filter(cond)


def merge_snapshot(batch_rows: DataFrame, path: str, part: str, keys: list[str], epoch_id: int) -> DataFrame | None:
    """Write the new snapshot of every partition in ``batch_rows`` (which
    carry full values for their keys) and return it as read back; None for
    an empty batch."""
    spark = batch_rows.sparkSession
    values = [str(v) for v in touched(batch_rows, part)]
    if not values:
        return None
    prev = read_snapshots(spark, path, part, snapshot_epochs(spark, path, part, values, before=epoch_id))
    rows = batch_rows.withColumn(EPOCH, F.lit(int(epoch_id)))
    if prev is not None:
        rows = prev.select(*rows.columns).unionByName(rows)
    snap = latest_by(rows, [part, *keys], [EPOCH]).drop(EPOCH)
    append_epoch(snap, path, epoch_id, (part,))
    return read_snapshots(spark, path, part, {v: int(epoch_id) for v in values}).drop(EPOCH)


def latest_snapshots(spark: SparkSession, path: str, part: str) -> DataFrame:
    """The newest snapshot of every partition (for final readers).  Newest epochs come
    from the partition columns alone and prune the read."""
    rows = spark.read.parquet(path)
    newest = rows.groupBy(part).agg(F.max(EPOCH).alias(EPOCH))
    return rows.join(newest, [part, EPOCH], "left_semi").drop(EPOCH)


def _folders(spark: SparkSession, path: str, name: str) -> tuple:
    """(file system, {value: path}) of the folders ``name=value`` directly below ``path``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return files, {}
    found = [f.getPath() for f in files.listStatus(root) if f.isDirectory()]
    return files, {p.getName().split("=", 1)[1]: p for p in found if p.getName().startswith(f"{name}=")}


def drop_superseded(spark: SparkSession, path: str, part: str, keep: int = 2) -> int:
    """Retention: delete all but the newest ``keep`` snapshots of every partition; returns
    how many.  Two are needed at least: a replayed batch reads the one before its own."""
    if keep < 2:
        raise ValueError("keep at least two snapshots")
    files, days = _folders(spark, path, part)
    gone = 0
    for day in days.values():
        _, epochs = _folders(spark, day.toString(), EPOCH)
        for e in sorted(epochs, key=int)[:-keep]:
            files.delete(epochs[e], True)
            gone += 1
    return gone


def drop_partitions(spark: SparkSession, path: str, part: str, before: str) -> int:
    """Retention: delete the partitions whose value (a date as text, say) is below ``before``."""
    files, found = _folders(spark, path, part)
    old = [p for v, p in found.items() if v < before]
    for p in old:
        files.delete(p, True)
    return len(old)


def drop_epochs(spark: SparkSession, path: str, before: int) -> None:
    """Retention: delete what batches before ``before`` wrote below ``path``."""
    files, epochs = _folders(spark, path, EPOCH)
    for e, folder in epochs.items():
        if int(e) < before:
            files.delete(folder, True)


# ---- compaction -----------------------------------------------------------------


def compact(spark: SparkSession, path: str, keys: list[str], epoch_id: int, order: list[str] | None = None, every: int = 20) -> bool:
    """Merge the deltas of a ``latest`` store from before batch ``epoch_id``; does its work once
    ``every`` batches have left theirs.

    The newest folder before the batch is of a finished batch, which never runs again.  To
    it are added the latest rows of the keys it lacks; then the older folders go.  A key
    has one row from then on, plus one for each later batch that touches it, so what a
    reader reads does not grow with the number of batches.  If the work is cut short, rows
    stand twice until it is done again; none is lost.
    """
    files, epochs = _folders(spark, path, EPOCH)
    done = sorted(int(e) for e in epochs if int(e) < epoch_id)
    if len(done) < max(2, every):
        return False
    newest = done[-1]
    rows = latest_by(spark.read.parquet(path).filter(F.col(EPOCH) <= newest), keys, order or [EPOCH])
    older = rows.filter(F.col(EPOCH) < newest).withColumn(EPOCH, F.lit(newest))
    older.write.mode("append").partitionBy(EPOCH).parquet(path)
    for e in done[:-1]:
        files.delete(epochs[str(e)], True)
    return True


def append_latest(batch: DataFrame, path: str, epoch_id: int, keys: list[str], order: list[str] | None = None, every: int = 20) -> None:
    """``append_epoch`` for a store that is read with ``latest``, kept short by ``compact``."""
    compact(batch.sparkSession, path, keys, epoch_id, order, every)
    append_epoch(batch, path, epoch_id)


def written(spark: SparkSession, path: str, part: str, epoch_id: int) -> list:
    """Values, as text, of a partition column in what batch ``epoch_id`` wrote: from the folders
    alone, so the batch itself need not run again."""
    rows = spark.read.schema(f"{part} string, {EPOCH} int").parquet(path)
    return [r[0] for r in rows.filter(F.col(EPOCH) == int(epoch_id)).select(part).distinct().collect()]


def append_keyed(
    batch: DataFrame, path: str, part: str, keys: list[str], epoch_id: int, every: int = 20, session: SparkSession | None = None, spread: int = 8
) -> DataFrame | None:
    """Append a batch's rows, which carry full values for their keys, and return the latest row
    of every key of the partitions it touches; None for an empty batch.

    What is written follows the batch, not the partition; what is read is a partition's
    merged rows and at most ``every`` deltas.  A batch that runs again replaces its own
    delta and reads none that came later.  The batch's plan, with its state, runs once, and
    writes at most ``spread`` files a partition.  Stored rows are read by ``session``: that
    of a micro-batch has no adaptive execution, the one the stream was started from may.
    """
    spark = session or batch.sparkSession
    batch_rows = batch.repartition(part, F.pmod(F.xxhash64(*keys), F.lit(spread)))
    append_epoch(batch_rows, path, epoch_id, (part,))
    values = [str(v) for v in written(spark, path, part, epoch_id)]
    if not values:
        return None
    for v in values:
        compact(spark, f"{path.rstrip('/')}/{part}={v}", keys, epoch_id, every=every)
    rows = spark.read.parquet(path).filter(F.col(part).cast("string").isin(values) & (F.col(EPOCH) <= int(epoch_id)))
    return latest_by(rows.select(*batch.columns, EPOCH), [part, *keys], [EPOCH]).drop(EPOCH)


# ---- progress -----------------------------------------------------------------


def read_progress(spark: SparkSession, path: str, epoch_id: int) -> dict | None:
    """What the newest batch before ``epoch_id`` wrote with ``write_progress``."""
    try:
        rows = spark.read.parquet(path).filter(F.col(EPOCH) < int(epoch_id))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    found = rows.orderBy(F.desc(EPOCH)).limit(1).collect()
    return found[0].asDict() if found else None


def write_progress(spark: SparkSession, path: str, epoch_id: int, row: dict, schema: str, keep: int = 5) -> None:
    """One row a batch; a replayed batch replaces its own, and old ones go."""
    append_epoch(spark.createDataFrame([row], schema).coalesce(1), path, epoch_id)
    drop_epochs(spark, path, epoch_id - keep)
