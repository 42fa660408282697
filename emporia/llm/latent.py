"""Benchmark decontamination by latent semantic retrieval.

Passages of all texts are TF-IDF vectors over hashed words.  One distributed pass
gives document frequencies, a second a random sketch of the passages' Gram matrix,
from which a randomised singular value decomposition follows.  Windows of every text
and benchmark items are compared by cosine in the latent space; for each pair found,
the longest common subsequence of words and the item's answer decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.words import Texts, Words, slices, word_hashes, words_of

DIMS = 8192
RANK, EXTRA = 96, 8
PASSAGE = 64
STEP = 4
WINDOWS = (16, 32, 64, 128)  # windows begin a quarter of their width apart
SLICE = 500_000
CHUNK = 2048  # blocks of STEP words whose sums are taken at once; a multiple of every step of windows
SUMMED = 2_000_000  # slices of the passes that add up
BLOCKS, SPREAD = 16, 32
NOISE = 1e-3  # smaller singular values, of the largest, are rounding: the sketch is summed in single precision
WEIGHED = 1 / 3  # an item with a smaller share of words that have a weight is searched for word by word


def dims_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) % DIMS


def random_directions(seed: int = 3) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((DIMS, RANK + EXTRA)).astype(np.float32)


def passages(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Dimension of every word, and its passage's number among those of these texts."""
    w = words_of(texts)
    dims = dims_of(word_hashes(texts, w))
    place = np.arange(len(dims)) - np.repeat(w.bounds[:-1], np.diff(w.bounds))
    return dims, np.cumsum(place % PASSAGE == 0) - 1


def frequencies(texts: Texts, total: np.ndarray) -> None:
    """Adds to the columns of ``total``: number of passages, and how many of them have each
    dimension."""
    dims, passage = passages(texts)
    if len(dims):
        pairs = np.sort((passage * DIMS + dims).astype(np.int64 if passage[-1] >= 2**31 // DIMS else np.int32))
        first = np.append(True, pairs[1:] != pairs[:-1])
        total[:, 0] += passage[-1] + 1
        total[:, 1] += np.bincount(pairs[first] % DIMS, minlength=DIMS)


def sketch(texts: Texts, weighted: np.ndarray, total: np.ndarray) -> None:
    """Adds B'A directions to ``total``, A being the TF-IDF rows of these texts' passages and
    B their word counts; ``weighted`` are the directions times the inverse frequencies, and
    a last row of zeros.

    Passages lie beside each other and are added up word by word, then by dimension, in
    blocks that stay in a core's cache.
    """
    dims, passage = passages(texts)
    used = weighted.any(axis=1)[dims]
    dims, passage = dims[used], passage[used]
    if not len(dims):
        return
    begins = np.append(True, passage[1:] != passage[:-1])
    row, at = np.cumsum(begins) - 1, np.flatnonzero(begins)
    words = np.full((PASSAGE, len(at)), DIMS)
    words[np.arange(len(dims)) - at[row], row] = dims
    projected = np.zeros((len(at), weighted.shape[1]), np.float32)
    for low in range(0, len(at), 256):
        part = projected[low : low + 256]
        for k in range(PASSAGE):
            part += weighted.take(words[k, low : low + 256], axis=0)
    by = np.argsort(dims.astype(np.uint16), kind="stable")
    dims, row = dims[by], row[by]
    cut = np.flatnonzero(np.append(True, dims[1:] != dims[:-1]))
    ends = np.append(cut, len(dims))
    for k in range(0, len(cut), 64):
        some = cut[k : k + 64]
        total[dims[some]] += np.add.reduceat(projected.take(row[some[0] : ends[k + len(some)]], axis=0), some - some[0], axis=0)


class Latent(NamedTuple):
    """Inverse document frequencies, and word vectors: the right singular vectors'
    rows over the singular values, each times its dimension's inverse frequency.  A
    bag's sum is its row of left singular vectors, in which no direction prevails.  The
    last row, for no word, is zero."""

    idf: np.ndarray
    words: np.ndarray
    singular: np.ndarray


def added_up(docs: DataFrame, columns: int, each) -> np.ndarray:
    """DIMS rows by ``columns`` to which ``each`` (slice of texts, sum) adds, over all ``docs``.

    Tasks add up what they read, blocks of dimensions of some tasks meet in a row each,
    and those in one row a block; every row has a fixed size, and only the last
    reach the driver.
    """
    step, schema = DIMS // BLOCKS, "block int, some int, part binary"

    def rows(sums: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        block, some = zip(*sums, strict=True) if sums else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(block, pa.int32()), pa.array(some, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "some", "part"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((DIMS, columns)), False
        for batch in batches:
            for t in slices(batch.column("text"), lower=True, size=SUMMED):
                each(t, total)
                seen = True
        if seen:
            mine = TaskContext.get().partitionId() % SPREAD
            yield rows({(k, mine): total[k * step : (k + 1) * step] for k in range(BLOCKS)})

    def add(whole: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                for block, some, part in zip(*(batch.column(c).to_pylist() for c in ("block", "some", "part")), strict=True):
                    key = (block, 0 if whole else some)
                    sums[key] = sums.get(key, 0) + np.frombuffer(part)
            yield rows(sums)

        return run

    parts = docs.select("text").mapInArrow(run, schema)
    some = parts.repartition("block", "some").mapInArrow(add(False), schema)
    found = some.repartition("block").mapInArrow(add(True), schema).collect()
    if not found:
        return np.zeros((DIMS, columns))
    return np.concatenate([np.frombuffer(r["part"]).reshape(step, columns) for r in sorted(found, key=lambda r: r["block"])])


def idf_of(table: np.ndarray, max_share: float) -> np.ndarray:
    """Inverse frequencies; dimensions in more than ``max_share`` of the passages get
    none."""
    n, df = table[0, 0], table[:, 1]
    return np.where(df <= max_share * n, np.log((n + 1) / (df + 1)) + 1e-3, 0)


def fit(docs: DataFrame, max_share: float = 0.03, seed: int = 3) -> Latent:
    """Randomised SVD of the TF-IDF passages of all ``docs`` (text): one pass for the
    frequencies, one for the sketch."""
    texts = docs.select("text")
    idf = idf_of(added_up(texts, 2, frequencies), max_share)
    directions = random_directions(seed)
    weighted = np.vstack([directions * idf[:, None], np.zeros(RANK + EXTRA)]).astype(np.float32)
    return solve(idf, added_up(texts, RANK + EXTRA, lambda t, total: sketch(t, weighted, total)) * idf[:, None], directions)


def solve(idf: np.ndarray, y: np.ndarray, directions: np.ndarray) -> Latent:
    """The Nystroem form A'A ~ Y (W'Y)^-1 Y', with the sketch Y = A'A W, gives the
    singular vectors and values of A."""
    # A small shift keeps the inner matrix positive; it is taken back from the values.
    shift = 1e-9 * np.linalg.norm(y) + 1e-12
    y = y + shift * directions
    inner = directions.T @ y
    half = np.linalg.cholesky((inner + inner.T) / 2 + 1e-12 * np.trace(inner) * np.eye(len(inner)))
    u, s, _ = np.linalg.svd(np.linalg.solve(half, y.T).T, full_matrices=False)
    singular = np.sqrt(np.maximum(s[:RANK] ** 2 - shift, 0))
    kept = singular > NOISE * max(singular.max(initial=0), 1e-300)
    words = idf[:, None] * u[:, :RANK] * np.where(kept, 1 / np.where(kept, singular, 1), 0)
    return Latent(idf, np.vstack([words, np.zeros(RANK)]).astype(np.float32), singular)


class Search(NamedTuple):
    """Thresholds: cosine of a candidate and share of the item's bits in the window, then
    share of the item's words in common order, and the lower share that is enough
    when the answer is there too."""

    cosine: float = 0.42
    bits: float = 0.3
    share: float = 0.6
    with_answer: float = 0.5


class Items(NamedTuple):
    """Benchmark items that have words: id, word hashes, unit latent vector, bits of
    its dimensions, the first word of the answer, the window that suits the length, and
    whether too few words have a weight, so that the latent vector can't find it."""

    ids: list[int]
    hashes: list[np.ndarray]
    vectors: np.ndarray
    bits: np.ndarray
    answer: list[int]
    window: np.ndarray
    exact: np.ndarray


def normal(hashes_column: pa.Array) -> Iterator[tuple[Texts, Words, np.ndarray]]:
    for t in slices(hashes_column, lower=True, size=SLICE):
        w = words_of(t)
        yield t, w, word_hashes(t, w)


def prepare_items(rows: list[tuple[int, str | None]], latent: Latent) -> Items:
    """The answer is the item's last sentence, its last eight words at most."""
    ids, hashes, vectors, bits, answer, exact = [], [], [], [], [], []
    for t, w, h in normal(pa.array([r[1] for r in rows], pa.string())):
        raw = t.data.tobytes()
        for k, (a, b) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)):
            if a == b:
                continue
            stops = [j for j in range(a, b - 1) if raw[w.ends[j] - 1 : w.ends[j]] in (b".", b"!", b"?", b":")]
            ids.append(rows[t.first + k][0])
            hashes.append(h[a:b])
            vectors.append(latent.words[dims_of(h[a:b])].sum(axis=0))
            bits.append(np.bitwise_or.reduce(signatures(dims_of(h[a:b]), latent.idf)))
            answer.append(max(stops[-1] + 1 - a if stops else 0, b - a - 8))
            exact.append(np.mean(latent.idf[dims_of(h[a:b])] > 0) < WEIGHED)
    sizes = np.array([len(h) for h in hashes])
    window = np.array([min(WINDOWS, key=lambda x: abs(math.log(x / s))) for s in sizes.tolist()], np.int64)
    v = np.array(vectors, np.float64).reshape(len(ids), RANK)
    return Items(ids, hashes, (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).astype(np.float32), np.array(bits, np.uint64).reshape(-1, 4), answer, window, np.array(exact, bool))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, on bit vectors: a row is an integer."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        m = masks.get(x)
        if m:
            u = row & m
            row = (row + u) | (row - u)
            row &= full
    return len(a) - row.bit_count()


def spans_in_order(hashes: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, least: float) -> np.ndarray:
    """Which spans [low, high) of ``hashes`` have at least ``least`` of the item's words
    in common order; of an item of more than 64 words, which have as many in any order."""
    words, back = np.unique(item, return_inverse=True)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    held = np.flatnonzero(words[at] == hashes)
    begin, end = np.searchsorted(held, low), np.searchsorted(held, high)
    spans = np.flatnonzero(end - begin >= least)
    if len(item) > 64 or not len(spans):
        return spans
    masks = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(masks, back, np.uint64(1) << np.arange(len(item), dtype=np.uint64))
    masks, begin, end = np.append(masks[at[held]], np.uint64(0)), begin[spans], end[spans]
    full = np.uint64((1 << len(item)) - 1)
    row = np.full(len(spans), full)
    for k in range(int((end - begin).max())):
        u = row & masks[np.where(begin + k < end, begin + k, -1)]
        row = ((row + u) | (row - u)) & full
    return spans[len(item) - np.bitwise_count(row).astype(np.int64) >= least]


def signatures(dims: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """256 bits for every dimension that is used, as four integers; DIMS has none."""
    bits = np.zeros((len(dims), 4), np.uint64)
    used = np.flatnonzero(np.append(idf, 0)[dims] > 0)
    bits[used, dims[used] // 64 % 4] = np.uint64(1) << (dims[used] % 64).astype(np.uint64)
    return bits


def candidates(hashes: np.ndarray, bounds: np.ndarray, latent: Latent, items: Items, search: Search) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, item, first word, last word, cosine) of windows that are close enough.

    Windows are sums of blocks of STEP words, doubled up to each width, of which only
    those stay at which wider windows begin; texts are set apart by empty blocks, so that
    each begins where the widest may.  Sums are taken CHUNK blocks at a time, which stay
    in a core's cache.  A pair that is close enough must also share some of the
    item's less frequent words, by the bits of their dimensions.  An item that has too few
    of those, as when its copies are what makes its words frequent, is compared word by
    word with all windows.
    """
    sizes, widest = np.diff(bounds), int(items.window.max())
    unit = max(1, widest // 4 // STEP)
    blocks = np.where(sizes > 0, np.maximum(widest // STEP, -(-sizes // (unit * STEP)) * unit), 0)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    dims = np.full(int(begin[-1]) * STEP, DIMS)
    dims[np.repeat(begin[:-1] * STEP - bounds[:-1], sizes) + np.arange(len(hashes))] = dims_of(hashes)
    signature = signatures(np.arange(DIMS + 1), latent.idf)
    levels = {}
    for width in np.unique(items.window).tolist():
        step = width // 4 // STEP
        count = np.where(sizes > 0, np.maximum(0, -(-(sizes - width) // (step * STEP))) + 1, 0)
        owner = np.repeat(np.arange(len(sizes)), count)
        place = (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)) * step
        first = bounds[owner] + place * STEP
        last = np.minimum(first + width, bounds[owner + 1])
        spans = [np.zeros((2, 0), np.int64)]
        for j in np.flatnonzero((items.window == width) & items.exact).tolist():
            mine = items.hashes[j]
            low, high = np.maximum(bounds[owner], first - len(mine)), np.minimum(bounds[owner + 1], last + len(mine))
            x = spans_in_order(hashes, low, high, mine, search.with_answer * len(mine))
            spans.append(np.stack([x, np.full(len(x), j)]))
        exact = np.concatenate(spans, axis=1)
        mine = np.flatnonzero((items.window == width) & ~items.exact)
        wanted = np.bitwise_count(items.bits[mine]).sum(axis=1)
        levels[width] = owner, begin[:-1][owner] + place, first, last, exact[:, np.argsort(exact[0], kind="stable")], mine, wanted
    for base in range(0, int(begin[-1]), CHUNK):
        words = dims[base * STEP : (base + CHUNK + widest // STEP) * STEP]
        sums, bits = latent.words.take(words[::STEP], axis=0), signature.take(words[::STEP], axis=0)
        for k in range(1, STEP):
            sums += latent.words.take(words[k::STEP], axis=0)
            bits |= signature.take(words[k::STEP], axis=0)
        width, apart = STEP, 1  # a row's words, and the blocks from one row to the next
        while width < widest:
            k, width = width // STEP // apart, 2 * width
            thin = max(1, width // 4 // STEP) // apart
            sums, bits, apart = sums[:-k:thin] + sums[k::thin], bits[:-k:thin] | bits[k::thin], apart * thin
            if width not in levels:
                continue
            owner, at, first, last, exact, mine, wanted = levels[width]
            low, high = np.searchsorted(at, [base, base + CHUNK]).tolist()
            rows = (at[low:high] - base) // apart
            v = sums.take(rows, axis=0)
            for x, j in exact[:, slice(*np.searchsorted(exact[0], [low, high]))].T.tolist():
                u = v[x - low]
                yield int(owner[x]), j, int(first[x]), int(last[x]), float(u @ items.vectors[j] / max(np.linalg.norm(u), 1e-12))
            if low == high or not len(mine):
                continue
            v /= np.maximum(np.sqrt(np.einsum("ij,ij->i", v, v)), 1e-12)[:, None]
            near = v @ items.vectors[mine].T
            i, j = np.divmod(np.flatnonzero(near.ravel() >= search.cosine), len(mine))
            shared = np.bitwise_count(bits.take(rows[i], axis=0) & items.bits[mine[j]]).sum(axis=1)
            good = np.flatnonzero(shared >= search.bits * wanted[j])
            i, j = i[good], j[good]
            some = low + i
            yield from zip(owner[some].tolist(), mine[j].tolist(), first[some].tolist(), last[some].tolist(), near[i, j].tolist(), strict=True)


def leaks(column: pa.Array, latent: Latent, items: Items, search: Search) -> Iterator[tuple[int, int, int, bool, float]]:
    """(text, item, common words, answer found, cosine): the best of each text and item."""
    distinct = [np.unique(mine) for mine in items.hashes]
    for t, w, h in normal(column):
        best: dict[tuple[int, int], tuple[int, bool, float]] = {}
        bounds = w.bounds.tolist()
        for text, item, a, b, cosine in candidates(h, w.bounds, latent, items, search) if len(items.ids) else ():
            mine, known = items.hashes[item], distinct[item]
            n = len(mine)
            span = h[max(bounds[text], a - n) : min(bounds[text + 1], b + n)]
            inside = span[known.take(known.searchsorted(span), mode="clip") == span]
            if len(inside) < search.with_answer * n:
                continue
            common = common_subsequence(mine, inside)
            if common < min(search.share, search.with_answer) * n:
                continue
            tail = mine[items.answer[item] :]
            answer = common_subsequence(tail, inside) >= 0.8 * len(tail)
            if common >= search.share * n or (answer and common >= search.with_answer * n):
                found = (common, answer, cosine)
                key = (t.first + text, item)
                best[key] = max(best.get(key, found), found)
        for (text, item), (common, answer, cosine) in best.items():
            yield text, item, common, answer, cosine


def item_rows(benchmark: DataFrame) -> list[tuple[int, str | None]]:
    """The benchmark is the stated query set, small enough for every worker."""
    return [(r["item_id"], r["text"]) for r in benchmark.where("item_id is not null").select("item_id", "text").orderBy("item_id", "text").toLocalIterator()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """(doc_id, item_id, common, item_words, answer, cosine): a row for every row of
    ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) of which it holds a copy
    or paraphrase.

    Words are compared with A-Z in lower case.  Null and empty texts hold nothing and
    items without words are held by nothing; repeated rows give repeated results, a
    null doc_id is handed through, items without an id are not searched for.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    latent = fit(docs)
    items = prepare_items(item_rows(benchmark), latent)
    shared = spark.sparkContext.broadcast((tuple(latent), tuple(items)))
    least = tuple(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, queries = Latent(*shared.value[0]), Items(*shared.value[1])
        for batch in batches:
            got = list(leaks(batch.column("text"), space, queries, Search(*least)))
            if got:
                text, item, common, answer, cosine = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(text, pa.int64())),
                        pa.array([queries.ids[i] for i in item], pa.int64()),
                        pa.array(common, pa.int64()),
                        pa.array([len(queries.hashes[i]) for i in item], pa.int64()),
                        pa.array(answer, pa.bool_()),
                        pa.array(cosine, pa.float64()),
                    ],
                    names=["doc_id", "item_id", "common", "item_words", "answer", "cosine"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, item_id long, common long, item_words long, answer boolean, cosine double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns."""
    latent = fit(docs)
    shared = docs.sparkSession.sparkContext.broadcast((tuple(latent), tuple(prepare_items(item_rows(benchmark), latent))))
    least = tuple(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, queries = Latent(*shared.value[0]), Items(*shared.value[1])
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            clean[[x[0] for x in leaks(batch.column("text"), space, queries, Search(*least))]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
