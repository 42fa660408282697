"""Periodic runs of words, by recompression.

A run is a stretch of words that repeats with period q at least three times over and
cannot be extended.  Texts are parsed into a run-length grammar: in turn, blocks of one
symbol become a symbol each (block compression), then pairs of a left and a right symbol
do (pair compression, the sides drawn by a hash of the symbol and the level), until two
symbols stand side by side nowhere or one is left.  Equal stretches get equal symbols but
for a few at their ends, so the longest common extension (LCE) of two places climbs
the grammar while symbols agree, and comes down to where the words part.

For every period q, the places 0, q, 2q, ... form a grid, n / q places; over all periods
that is a harmonic sum.  A run of period q holds two grid places a period apart from
which at least q words agree.  Such pairs are the candidates, and the exact extensions to
both sides give the run.  No suffix array is built, and no pair of rows compared.

All texts of a slice share one grammar; a symbol of its own behind each text ends every
extension there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.llm.words import mix

SLICE = 2_000_000
CANDIDATES = 400_000
LEAST, TIMES = 24, 3


class Level(NamedTuple):
    """One sequence of the grammar: its symbols, how many copies follow each (itself
    included), the first word under each, each symbol's parent above, and whether it is
    the first below that parent.  The topmost level has no parents."""

    symbol: np.ndarray
    copies: np.ndarray
    start: np.ndarray
    parent: np.ndarray
    first: np.ndarray


def _copies(symbol: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(np.append(symbol[1:] != symbol[:-1], True))
    return np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(symbol)) + 1


def compress(symbols: np.ndarray) -> list[Level]:
    """The levels of the grammar of ``symbols``, block and pair compression in turn.  A
    round that joins nothing adds no level."""
    levels: list[Level] = []
    symbol, start, turn = symbols.astype(np.int64), np.arange(len(symbols)), 0
    while True:
        n, blocks = len(symbol), turn % 2 == 0
        first = np.ones(n, bool)
        if blocks:
            first[1:] = symbol[1:] != symbol[:-1]
        else:
            side = mix(symbol.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1)
            first[1:] = ~((side[:-1] == 0) & (side[1:] == 1))
        at = np.flatnonzero(first)
        turn += 1
        if len(at) == n > 1:
            continue
        levels.append(Level(symbol, _copies(symbol), start, np.cumsum(first) - 1, first))
        if n <= 1:
            return levels
        size = np.diff(np.append(at, n))
        # What tells parents apart: symbol and copies, or the two symbols.
        other = size if blocks else np.where(size == 2, symbol[np.minimum(at + 1, n - 1)] + 1, 0)
        key = symbol[at] * (int(other.max()) + 1) + other
        symbol, start = np.unique(key, return_inverse=True)[1].astype(np.int64), start[at]


def mirrored(levels: list[Level], n: int) -> list[Level]:
    """The same grammar read from right to left."""
    out = []
    for x in levels:
        end = np.append(x.start[1:], n)
        last = np.append(x.first[1:], True)
        symbol = np.ascontiguousarray(x.symbol[::-1])
        out.append(Level(symbol, _copies(symbol), (n - end)[::-1], np.ascontiguousarray((x.parent[-1] - x.parent)[::-1]), np.ascontiguousarray(last[::-1])))
    return out


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words agree from places ``a`` and ``b`` on, pairwise; a < b, and some symbol
    at or behind b stands nowhere else."""
    begin = a
    at = np.arange(len(a))
    parted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # Up: within a level until both places begin a parent, as long as symbols agree.
    for x in levels:
        up: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        stop: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            same = x.symbol[a] == x.symbol[b]
            stop.append((at[~same], a[~same], b[~same]))
            at, a, b = at[same], a[same], b[same]
            both = x.first[a] & x.first[b]
            up.append((at[both], x.parent[a[both]], x.parent[b[both]]))
            at, a, b = at[~both], a[~both], b[~both]
            step = np.minimum(x.copies[a], x.copies[b])
            a, b = a + step, b + step
        parted.append(tuple(np.concatenate(c) for c in zip(*stop, strict=True)) if stop else (at, a, b))
        at, a, b = (np.concatenate(c) for c in zip(*up, strict=True)) if up else (at, a, b)
    # Down: to the first children, and on while they agree.
    at = a = b = np.empty(0, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x = levels[k]
        if len(at):
            heads = np.flatnonzero(x.first)
            a, b, todo = heads[a], heads[b], np.arange(len(at))
            while len(todo):
                todo = todo[x.symbol[a[todo]] == x.symbol[b[todo]]]
                step = np.minimum(x.copies[a[todo]], x.copies[b[todo]])
                a[todo] += step
                b[todo] += step
        at, a, b = (np.concatenate(c) for c in zip((at, a, b), parted[k], strict=True))
    out = np.empty(len(begin), np.int64)
    out[at] = a - begin[at]
    return out


def _grid(symbols: np.ndarray, lows: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of grid places whose word stands again one period on, by text and
    period, about ``CANDIDATES`` at a time; no period of a text is cut in two."""
    held, count = [], 0
    for low, n in zip(lows.tolist(), sizes.tolist(), strict=True):
        longest = n // TIMES if n >= LEAST else 0
        places = n // np.arange(1, longest + 1) - 1
        total = np.cumsum(places)
        period = 1
        while period <= longest:
            done = total[period - 2] if period > 1 else 0
            to = max(period + 1, int(np.searchsorted(total, done + CANDIDATES, side="right")) + 1)
            counts = places[period - 1 : to - 1]
            q = np.repeat(np.arange(period, to), counts)
            k = np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)
            place = low + k * q
            same = symbols[place] == symbols[place + q]
            held.append((place[same], q[same]))
            count += len(held[-1][0])
            if count > CANDIDATES:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                held, count = [], 0
            period = to
    if count:
        yield tuple(np.concatenate(c) for c in zip(*held, strict=True))


def find_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of every run, in this order; text t is the word ids
    words[bounds[t] : bounds[t + 1]]."""
    sizes = np.diff(bounds)
    texts = len(sizes)
    # A symbol of its own before each text and behind the last.
    lows = bounds[:-1] + np.arange(1, texts + 1)
    n = len(words) + texts + 1
    symbols = np.empty(n, np.int64)
    inside = np.ones(n, bool)
    inside[np.append(lows - 1, n - 1)] = False
    symbols[inside] = words
    symbols[~inside] = (int(words.max()) + 1 if len(words) else 0) + np.arange(texts + 1)
    levels: list[Level] = []
    found = [np.empty((0, 3), np.int64)]
    for place, q in _grid(symbols, lows, sizes):
        if not levels:
            levels = compress(symbols)
            back = mirrored(levels, n)
        forward = extensions(levels, place, place + q)
        long = forward >= q
        place, q, forward = place[long], q[long], forward[long]
        # Of the grid places of one run, the first is enough.
        inner = np.zeros(len(place), bool)
        inner[1:] = (q[1:] == q[:-1]) & (place[1:] == place[:-1] + q[1:])
        place, q, forward = place[~inner], q[~inner], forward[~inner]
        # Mirrored, the later place comes first.
        before = extensions(back, n - place - q, n - place)
        long = before + q + forward >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([place - before, before + q + forward, q], axis=1)[long])
    rows = np.concatenate(found)
    # The smallest period of a stretch; others are its multiples.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    text = np.searchsorted(lows, rows[:, 0], side="right") - 1
    out = np.column_stack([text, rows[:, 0] - lows[text], rows[:, 1], rows[:, 2]])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """``words`` without those that any of ``runs`` (start, length, period) holds behind its
    first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ADDED = (
    T.StructType()
    .add("n_words", "long")
    .add("runs", T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long")))
    .add("collapsed", "string")
)


def _slice_runs(texts: list[bytes]) -> tuple[pa.Array, pa.Array, pa.Array]:
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    words = [t.split() for t in texts]
    bounds = np.cumsum([0, *map(len, words)])
    rows = find_runs(np.fromiter(map(ids.__getitem__, chain.from_iterable(words)), np.int64, int(bounds[-1])), bounds)
    cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in (1, 2, 3)], fields=list(RUN)))
    kept = [b" ".join(collapse(w, rows[a:b, 1:]) if b > a else w).decode("utf-8", "replace") for w, a, b in zip(words, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return pa.array(np.diff(bounds)), lists, pa.array(kept, pa.string())


def word_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` without ``text``, with n_words, ``runs`` and ``collapsed``, which
    replace columns of those names.

    ``runs``: an array of (start, length, period) by start, then period, of all
    stretches of ``text`` with smallest period ``period`` and a length of at least 24
    and three periods that no neighbouring word extends.  ``collapsed``: the words
    joined by one space, without those that a run holds behind its first period.  A
    null, empty or blank text has no words and no runs.  Rows are judged alone,
    whatever their ids; a text is never cut, and nothing is shuffled.
    """
    rest = docs.drop("n_words", "runs", "collapsed")
    names = [c for c in rest.columns if c != text]
    schema = T.StructType([*(rest.schema[c] for c in names), *ADDED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text).cast(pa.large_binary())
            held, size, at = [], 0, 0
            for k in range(batch.num_rows):
                held.append(column[k].as_py() or b"")
                size += len(held[-1])
                if size >= SLICE or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, len(held)) for c in names), *_slice_runs(held)], names=[*names, "n_words", "runs", "collapsed"])
                    held, size, at = [], 0, k + 1

    return rest.mapInArrow(run, schema)


def plant_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where, with h the crc32 of the decimal doc_id, g = h / 10 and n
    words, each row of h % 10 = 0 repeats from word a = g % n on its next
    p = 1 + (n - a) / (3 + g % 8) words (whole divisions) up to its old length.  Rows
    without a doc_id or words stay."""
    w = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("_h"))
    picked = (F.col("_h") % 10 == 0) & F.col("doc_id").isNotNull()
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    w = w.withColumn("_w", F.when(picked, words))
    w = w.selectExpr("*", "size(_w) as _n", "_h div 10 as _g").withColumn("_a", F.expr("if(_n > 0, int(_g % _n), 0)"))
    w = w.withColumn("_p", F.expr("int(1 + (_n - _a) div (3 + _g % 8))"))
    again = F.expr("concat_ws(' ', slice(_w, 1, _a), slice(flatten(array_repeat(slice(_w, _a + 1, _p), int(ceil((_n - _a) / _p)))), 1, _n - _a))")
    return w.select("doc_id", F.when(F.col("_n") > 0, again).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the one with the greatest length / period (ties:
    smallest start, then period; nulls without a run), and digests of all runs and of
    the collapsed words."""
    rows = word_runs(docs)
    # Exact fractions: lengths and periods are crossed, not divided.
    best = F.expr("""aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>),
        (x, y) -> if(x is null or y.length * x.period > x.length * y.period, y, x))""")
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), listed.alias("_listed"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        *(F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2("_listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
