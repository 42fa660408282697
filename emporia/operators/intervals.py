"""Lookup of values in overlapping ranges by an interval index.

The index is built in Spark in three steps.

1. The value space is cut into slots at quantiles of the ranges' starts.
2. A range is sent to the slots of its two ends.  The slots between are covered whole, and
   of the ranges that cover a slot whole only the best counts there: they are split into
   nodes of a binary tree over the slots (at most two a level), the best of a node
   is kept by an aggregate, and a slot takes the best of its ancestors.  A range
   over everything is a handful of rows, not one for every slot.
3. A sweep cuts each slot's ranges into disjoint pieces, each with the best range there.

A value meets the row of its slot by an equi-join and finds its piece there by binary
search, so no row is copied and no list is read through.  Values may be numbers (IPv4) or
binary of one length (IPv6): anything Spark can order.
"""

from __future__ import annotations

import heapq
import sys
import uuid
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.session import scratch_path

# The sweep runs in Python workers, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOT_RANGES = 256
MOST_SLOTS = 4096


def position(edges: Column, value: Column, size: int | None = None) -> Column:
    """How many of the sorted array ``edges`` are not above ``value``, by binary search: from
    the greatest power of two down, is there such an edge that many places further on?"""
    powers = [1 << k for k in reversed(range((size or 1 << 30).bit_length()))]
    steps = F.array(*map(F.lit, powers))
    if size is None:
        steps = F.filter(steps, lambda step: step <= F.size(edges))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) <= value, at + step).otherwise(at))


def _int(x) -> int:
    return int.from_bytes(x, "big") if isinstance(x, (bytes, bytearray)) else int(x)


def sweep(ranges: list[tuple], whole: tuple | None, low: int, high: int) -> list[tuple[int, int, object]]:
    """Disjoint (start, end, payload) of ``low``..``high`` from ``ranges`` (start, end, rank,
    payload), the least rank winning; ``whole`` (rank, payload) covers everything."""
    points = sorted({low, *(s for s, _, _, _ in ranges if s > low), *(e + 1 for _, e, _, _ in ranges if e < high)})
    begins = sorted(range(len(ranges)), key=lambda i: ranges[i][0])
    live: list[tuple] = [] if whole is None else [(whole[0], high, -1, whole[1])]
    out: list[tuple[int, int, object]] = []
    at = 0
    for k, p in enumerate(points):
        while at < len(begins) and ranges[begins[at]][0] <= p:
            s, e, rank, payload = ranges[begins[at]]
            heapq.heappush(live, (rank, e, begins[at], payload))
            at += 1
        while live and live[0][1] < p:
            heapq.heappop(live)
        if live:
            end = points[k + 1] - 1 if k + 1 < len(points) else high
            if out and out[-1][2] == live[0][3] and out[-1][1] == p - 1:
                out[-1] = (out[-1][0], end, live[0][3])
            else:
                out.append((p, end, live[0][3]))
    return out


class IntervalIndex(NamedTuple):
    """``pieces``: slot, starts, ends, payloads (arrays by start); ``edges``: the starts of all
    slots but the first, at most ``MOST_SLOTS``, in the driver."""

    pieces: DataFrame
    edges: list

    def slot(self, value: Column) -> Column:
        if not self.edges:
            return F.lit(0)
        # One literal for all edges; bytes compare as their hexadecimal text does.
        if isinstance(self.edges[0], bytes):
            return position(F.lit(np.array([e.hex().upper() for e in self.edges])), F.hex(value), len(self.edges))
        return position(F.lit(np.array(self.edges, np.int64)), value, len(self.edges))


def _edges(starts: DataFrame, slot_ranges: int) -> list:
    """Starts of the slots: quantiles of a sample.  They decide how the work is dealt, not
    what is found."""
    few = starts.limit(slot_ranges + 1).collect()
    if len(few) <= slot_ranges:
        return []
    n = starts.count()
    slots = min(MOST_SLOTS, 1 << (-(-n // slot_ranges) - 1).bit_length())
    drawn = sorted(bytes(r[0]) if isinstance(r[0], bytearray) else r[0] for r in starts.sample(min(1.0, 20 * slots / n), 7).collect())
    picked = [drawn[len(drawn) * k // slots] for k in range(1, slots)] if drawn else []
    return sorted(set(picked))


def build_index(ranges: DataFrame, start: str, end: str, payload: str, width: Column, slot_ranges: int = SLOT_RANGES) -> IntervalIndex:
    """Index of ``ranges``; where several hold a value, the one with the least (``width``,
    ``start``, ``payload``) wins.  Ranges with a null bound or an end before the start hold
    nothing; a null payload is kept.  The pieces are written to the shared folder, so
    a stream that looks values up does not cut them again for every batch."""
    spark = ranges.sparkSession
    kind = ranges.schema[start].dataType
    rows = ranges.filter(F.col(start) <= F.col(end)).select(F.col(start).alias("start"), F.col(end).alias("end"), F.col(payload).cast("string").alias("payload"), width.alias("width"))
    index = IntervalIndex(None, _edges(rows.select("start"), slot_ranges))
    best = F.min(F.struct("width", "start", "payload", "end"))
    rows = rows.withColumn("lo", index.slot(F.col("start"))).withColumn("hi", index.slot(F.col("end")))
    if index.edges:
        path = scratch_path(spark, f"ranges-{uuid.uuid4().hex}")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
    one = F.col("lo") == F.col("hi")
    ends = rows.select(F.explode(F.when(one, F.array("lo")).otherwise(F.array("lo", "hi"))).alias("slot"), F.lit(False).alias("whole"), "start", "end", "payload")
    parts = ends
    if index.edges:
        slots, levels = len(index.edges) + 1, (len(index.edges)).bit_length() + 1
        # Nodes of the binary tree that make up the slots strictly between lo and hi.
        nodes = [n for level in range(levels) for n in _nodes(level)]
        inner = rows.filter(F.col("hi") - F.col("lo") > 1).select("start", "end", "payload", "width", F.explode(F.filter(F.array(*nodes), lambda n: n.isNotNull())).alias("node"))
        top = inner.groupBy("node.level", "node.place").agg(best.alias("best"))
        every = spark.range(slots).select(F.col("id").cast("int").alias("slot"), F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
        every = every.withColumn("place", F.expr("shiftright(slot, level)"))
        whole = every.join(top, ["level", "place"]).groupBy("slot").agg(F.min("best").alias("best"))
        parts = parts.unionByName(whole.select("slot", F.lit(True).alias("whole"), "best.start", "best.end", "best.payload"))
    schema = T.StructType().add("slot", T.IntegerType()).add("starts", T.ArrayType(kind)).add("ends", T.ArrayType(kind)).add("payloads", T.ArrayType(T.StringType()))
    edges = [_int(e) for e in index.edges]
    size = 16 if isinstance(kind, T.BinaryType) else 0

    def cut(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows, cover = [], None
        lows, highs = pdf["start"].map(_int).tolist(), pdf["end"].map(_int).tolist()
        texts = [None if x is None or x != x else x for x in pdf["payload"].tolist()]
        for low, high, text, whole in zip(lows, highs, texts, pdf["whole"].tolist(), strict=True):
            rank = (high - low, low, text is not None, text or "")
            if whole:
                cover = (rank, text)
            else:
                rows.append((low, high, rank, text))
        slot = key[0]
        low = edges[slot - 1] if slot else min([*lows, edges[0]] if edges else lows)
        high = edges[slot] - 1 if slot < len(edges) else max(highs)
        pieces = sweep(rows, cover, low, high)

        def back(x: int):
            return x.to_bytes(size, "big") if size else x

        return pd.DataFrame({"slot": [slot], "starts": [[back(s) for s, _, _ in pieces]], "ends": [[back(e) for _, e, _ in pieces]], "payloads": [[p for _, _, p in pieces]]})

    path = scratch_path(spark, f"intervals-{uuid.uuid4().hex}")
    parts.groupBy("slot").applyInPandas(cut, schema).write.parquet(path)
    return IntervalIndex(spark.read.schema(schema).parquet(path), index.edges)


def _nodes(level: int) -> list[Column]:
    """The tree's nodes at ``level`` that the slots lo + 1 .. hi - 1 need, as (level, place) or null."""
    size = 1 << level
    low = F.ceil((F.col("lo") + 1) / size).cast("int")
    high = F.floor(F.col("hi") / size).cast("int")
    node = lambda place: F.struct(F.lit(level).alias("level"), place.cast("int").alias("place"))
    return [F.when((low < high) & (low % 2 == 1), node(low)), F.when((low < high) & (high % 2 == 1), node(high - 1))]


def lookup(df: DataFrame, value: str, index: IntervalIndex, name: str) -> DataFrame:
    """``df`` with ``name``: the payload of the best range that holds ``value``, null for none.

    Rows without a value meet no slot and are spread by a key of their own instead of
    gathering under null.
    """
    v = F.col(value)
    left = df.withColumn("slot", F.when(v.isNotNull(), index.slot(v)).otherwise((-F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) - 1).cast("int")))
    both = left.join(index.pieces, "slot", "left").withColumn("_at", position(F.col("starts"), v) - 1)
    held = (F.col("_at") >= 0) & (F.get("ends", F.col("_at")) >= v)
    return both.withColumn(name, F.when(held, F.get("payloads", F.col("_at")))).select(*[F.col(c) for c in df.columns if c != name], name)
