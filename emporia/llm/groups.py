"""Groups of rows in Python tasks, large ones cut into pairs of blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.scratch import stored

BLOCK = 4096


def in_blocks(rows: DataFrame, group: str, key: str, block: int = BLOCK) -> DataFrame:
    """``rows`` (a stored table) with own, low and high.

    A group of up to ``block`` rows is one task (0, 0).  A larger one is dealt to
    blocks by a hash of ``key``, and a row goes to every pair of blocks (low, high)
    that its own is part of, so all pairs of rows meet, each task with two blocks.
    """
    # Written, so that the join is between plain shuffles and a hot group can be split.
    n = stored(rows.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks")), "blocks")
    return (
        rows.join(n, group)
        .withColumn("own", F.pmod(F.xxhash64(key), F.col("_blocks")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
        .withColumn("low", F.least("own", "_other"))
        .withColumn("high", F.greatest("own", "_other"))
        .drop("_blocks", "_other")
    )


def by_group(rows: DataFrame, keys: list[str], each: Callable[[pa.Table], Iterator[tuple]], schema: str) -> DataFrame:
    """``each`` of the rows that agree in the integer columns ``keys``, as an Arrow
    table, gives tuples for ``schema`` (DDL of longs).  Groups follow each other in
    sorted partitions; a task holds one at a time."""
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last, out = None, []

        def emit():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(k).to_numpy() for k in keys])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                mark = tuple(marks[:, a].tolist())
                if held and mark != last:
                    group, held = pa.Table.from_batches(held), []
                    out.extend(each(group))
                held.append(batch.slice(a, b - a))
                last = mark
                if len(out) > 20_000:
                    yield emit()
                    out = []
        if held:
            out.extend(each(pa.Table.from_batches(held)))
        if out:
            yield emit()

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
