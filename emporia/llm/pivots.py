"""Embedding near-dedup with a pivot-permutation index.

A vector is described by its nearest pivots in order.  Every two of a vector's
pivots are a list that it stands in, so two vectors that share at least two pivots
meet, and cosines in double precision decide.  A pair that meets in several
lists counts in the one of its two smallest shared pivots.

Equal vectors are one entry with a weight.  Lists that are too long for a task are
cut into blocks whose pairs are tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.components import components
from emporia.llm.groups import by_group, in_blocks
from emporia.llm.scratch import stored

LIST_ROWS = "list long, cls long"
CLASS = ["cls", "vec_id", "weight", "embedding"]
DESCRIBED = "cls long, vec_id long, weight long, embedding array<double>, orders array<int>"
RECALL, PROBES, FURTHEST = 0.95, 2000, 24


def matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are usable, their unit vectors): no null, finite, not zero, and of
    ``width`` components if that is given."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    if width is None:
        width = int(sizes.max(initial=0))
    fits = np.flatnonzero(sizes == width) if width else np.empty(0, np.int64)
    flat = column.take(pa.array(fits)).flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(fits), width)  # a null becomes NaN
    with np.errstate(over="ignore", invalid="ignore"):
        scale = np.abs(values).max(axis=1, initial=0)
        good = np.isfinite(values).all(axis=1) & (scale > 0)
    values = values[good] / scale[good, None]
    return fits[good], values / np.linalg.norm(values, axis=1, keepdims=True)


def choose_pivots(sample: pa.Array, most: int, apart: float) -> np.ndarray:
    """Up to ``most`` unit vectors of a sample, none closer than ``apart`` to one before."""
    _, unit = matrix(sample)
    taken, n = np.empty((most, unit.shape[1])), 0
    for v in unit:
        if n < most and (taken[:n] @ v).max(initial=-1) < apart:
            taken[n], n = v, n + 1
    return taken[:n]


def near_pivots(unit: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """Ids of each vector's nearest pivots, nearest first."""
    near = min(near, len(pivots))
    out = np.empty((len(unit), near), np.int64)
    for at in range(0, len(unit), 1024):
        score = unit[at : at + 1024] @ pivots.T
        top = np.argpartition(-score, near - 1, axis=1)[:, :near]
        rank = np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable")
        out[at : at + 1024] = np.take_along_axis(top, rank, 1)
    return out


def enough_near(pivots: np.ndarray, probes: np.ndarray, least: float, near: int) -> int:
    """How many nearest pivots, ``near`` or more, a vector needs so that pairs with cosine
    ``least`` share two of them with a probability of ``RECALL``: more pivots need more.
    Measured on unit vectors ``probes``, each against itself turned in a random direction."""
    most = min(len(pivots), max(near, FURTHEST))
    if most <= near or not len(probes):
        return min(near, len(pivots))
    turn = np.random.default_rng(5).standard_normal(probes.shape)
    turn -= (turn * probes).sum(axis=1, keepdims=True) * probes
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
    a, b = (near_pivots(v, pivots, most) for v in (probes, least * probes + math.sqrt(max(0, 1 - least * least)) * turn))
    for k in range(near, most):
        if np.mean((a[:, :k, None] == b[:, None, :k]).any(axis=2).sum(axis=1) >= 2) >= RECALL:
            return k
    return most


def list_ids(orders: np.ndarray, pivots: int) -> np.ndarray:
    """The lists of each row: one for every two of its pivots."""
    a, b = np.triu_indices(orders.shape[1], 1)
    low, high = np.minimum(orders[:, a], orders[:, b]), np.maximum(orders[:, a], orders[:, b])
    return low * pivots + high


def _describe(pivots: np.ndarray, near: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, unit = matrix(batch.column("embedding"), pivots.shape[1])
            if len(rows):
                orders = near_pivots(unit, pivots, near)
                cuts = np.arange(len(rows) + 1, dtype=np.int32) * orders.shape[1]
                kept = batch.take(pa.array(rows))
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(orders.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in CLASS), lists], names=[*CLASS, "orders"])

    return run


def _list_rows(pivots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids = list_ids(_orders(batch.column("orders")), pivots)
                cls = np.repeat(batch.column("cls").to_numpy(), ids.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(ids.ravel()), pa.array(cls)], names=["list", "cls"])

    return run


def _orders(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def _links(pivots: int, least: float):
    """Per list (or pair of its blocks): links by class as (class, class, links), and
    links that connect the same vectors as (vec_id, vec_id, 0).  Without pivots, a list holds
    all vectors that may link with one another."""

    def each(group: pa.Table) -> Iterator[tuple]:
        n = group.num_rows
        if n < 2:
            return
        _, unit = matrix(group.column("embedding"))
        orders = _orders(group.column("orders")) if pivots else None
        vec, cls, weight, own = (group.column(c).to_numpy() for c in ("vec_id", "cls", "weight", "own"))
        here, low, high = (group.column(c)[0].as_py() for c in ("list", "low", "high"))
        part, links = np.arange(n), np.zeros(n, np.int64)
        for at in range(0, n, 512):
            i, j = np.nonzero(unit[at : at + 512] @ unit.T >= least)
            i += at
            keep = (i < j) & ((own[i] != own[j]) if low != high else (own[i] == own[j]))
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if pivots:
                # The pair belongs to the list of its two smallest shared pivots.
                mine_i, mine_j = orders[i], orders[j]
                shared = (mine_i[:, :, None] == mine_j[:, None, :]).any(axis=2)
                ranked = np.sort(np.where(shared, mine_i, pivots), axis=1)
                mine = ranked[:, 0] * pivots + ranked[:, 1] == here
                i, j = i[mine], j[mine]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            for a in np.unique(i).tolist():
                others = j[np.searchsorted(i, a) : np.searchsorted(i, a, "right")]
                for p in np.unique(part[others]).tolist():
                    if p != part[a]:
                        yield int(vec[a]), int(vec[others[part[others] == p][0]]), 0
                        part[part == p] = part[a]
        for k in np.flatnonzero(links).tolist():
            yield int(cls[k]), int(cls[k]), int(links[k])

    return each


def _indexed_links(classes: DataFrame, least: float, near: int, list_rows: int, most_pivots: int, block: int) -> DataFrame:
    """Links of ``classes``, stored rows of one length, through the index."""
    n = classes.count()
    lists = near * (near - 1) // 2
    pivots_wanted = min(most_pivots, max(2 * near, math.ceil(math.sqrt(2 * lists * n / list_rows))))
    sample = classes.select("embedding", F.xxhash64("cls").alias("h")).orderBy("h").limit(2 * pivots_wanted).select("embedding").toArrow()
    pivots = choose_pivots(sample.column("embedding"), pivots_wanted, least) if n else np.empty((0, 0))
    if len(pivots) < 2:
        # One direction only: all that is alike is one list.
        pivots = np.vstack([pivots, -pivots, np.roll(pivots, 1, axis=1)])[:2] if len(pivots) else np.ones((2, 1))
    # The last of the sample are the least likely to be pivots.
    near = enough_near(pivots, matrix(sample.column("embedding"))[1][-PROBES:], least, near)
    # Written with their pivots, so that a pair sees the same ones in all its lists.
    described = stored(classes.select(*CLASS).mapInArrow(_describe(pivots, near), DESCRIBED), "described")
    placed = stored(described.select("cls", "orders").mapInArrow(_list_rows(len(pivots)), LIST_ROWS), "lists")
    several = placed.groupBy("list").count().where("count > 1").select("list")
    full = in_blocks(placed.join(several, "list", "left_semi"), "list", "cls", block).join(described, "cls")
    return by_group(full, ["list", "low", "high"], _links(len(pivots), least), "a long, b long, n long")


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.9,
    near: int = 6,
    list_rows: int = 64,
    most_pivots: int = 30_000,
    block: int = 4096,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    A link is a pair of vectors of one length with cosine >= ``least`` in double precision
    that shares two of its nearest pivots: ``near`` of them, or as many more as a
    measurement with the table's pivots finds necessary.  Pivots are rows with the
    smallest hashes, no two of them linked; their number follows the square root of the
    row count, so that lists keep about ``list_rows`` rows (more where more pivots are
    near), up to ``most_pivots``.  Every length of more than ``block`` different vectors,
    and the usual one, has an index of its own; of other lengths, all vectors are one
    list.  Vectors that are null, zero, or hold a null or non-finite component link with
    nothing.  Rows that share a vec_id are one node, and n_links adds the links of its
    different vectors.  Rows with a null vec_id link with nothing and are kept.  Other
    columns are not read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.expr("embedding is not null and size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)")
    good = rows.where("vec_id is not null").where(usable)
    classes = stored(
        good.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count_distinct("vec_id").alias("weight")).withColumn("cls", F.xxhash64("embedding")),
        "vectors",
    )
    member = good.withColumn("cls", F.xxhash64("embedding")).select("vec_id", "cls").join(classes.select("cls", F.col("vec_id").alias("rep"), "weight"), "cls").distinct()
    width = F.size("embedding")
    widths = classes.groupBy(width.alias("width")).count().orderBy(F.desc("count"), F.desc("width"))
    usual = widths.limit(1).collect()
    large = {r["width"] for r in usual} | {r["width"] for r in widths.where(F.col("count") > block).collect()}
    links = [_indexed_links(classes.where(width == w), least, near, list_rows, most_pivots, block) for w in sorted(large)]
    rest = stored(classes.where(~width.isin(*large)).select(width.cast("long").alias("list"), "cls"), "other-lengths") if large else None
    if rest is not None and not rest.isEmpty():
        links.append(by_group(in_blocks(rest, "list", "cls", block).join(classes, "cls"), ["list", "low", "high"], _links(0, least), "a long, b long, n long"))
    found = stored(reduce(DataFrame.union, links) if links else vectors.sparkSession.createDataFrame([], "a long, b long, n long"), "links")
    more = found.where("a = b").groupBy("a").agg(F.sum("n").alias("more"))
    roots = components(found.where("a <> b").select("a", "b").union(member.select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))))
    per_node = (
        member.join(more.select(F.col("a").alias("cls"), "more"), "cls", "left")
        .groupBy("vec_id")
        .agg(F.sum(F.col("weight") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"))
    )
    return (
        rows.select("vec_id")
        .join(per_node, "vec_id", "left")
        .join(roots.select(F.col("node").alias("vec_id"), "root"), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
